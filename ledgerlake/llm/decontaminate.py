"""Benchmark decontamination by suffix arrays of the training documents.

Documents are read shard by shard: a shard is a run of documents of at most ``SHARD_WORDS``
words (one longer document is a shard of its own). Its word sequences, each ended by a mark that
no benchmark has, get a suffix array by prefix doubling, ordered as deep as the longest benchmark
item. Every benchmark suffix is then binary-searched: the interval is narrowed word by word
until nothing matches, which gives its longest verbatim match and, at the depth of a window, all
places of it in the shard.

Words: A-Z lower-cased, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, held as 64-bit
hashes. A window is 10 words in a row of an item, or the whole item if it has fewer.

Defined cases: null and empty texts have no words; items without words have no window; a null
item_id still counts as an item (written as an empty string); equal item_ids count once; repeated
documents are separate rows; other columns are not read; empty tables give what follows.

Scale: documents are never shuffled. The benchmark is the stated query set: it is dealt to
blocks of at most ``BLOCK_WORDS`` words on average, one pass over the rows each in the same
stage, so what a worker holds of it is bounded. The last pass also gives the result: every pass
of a stage keeps a Python worker of its own on each core, whose memory stays taken afterwards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import WordHasher, bounded_batches, columns, documents, raw_texts

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_WORDS = 1 << 20
_STATE = "_spans binary, _items string"


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the suffixes of a sequence of ranks (>= 0), ordered by their first ``depth``
    symbols at least; only runs that are still tied are ordered again."""
    n = len(words)
    top = int(words.max(initial=0)) + 2
    span, bits = 1, max(1, int(top).bit_length())
    key = words.astype(np.int64) + 1
    while (span + 1) * bits < 63 and span < 3:  # pack up to three symbols into the first key
        nxt = np.zeros(n, np.int64)
        nxt[:n - span] = words[span:] + 1
        key = (key << bits) | nxt
        span += 1
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while span < depth:
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        rows = order[at]
        after = rows + span
        nxt = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        head = rank[rows]
        sub = np.argsort(head * (n + 1) + nxt, kind="stable")
        rows, head, nxt = rows[sub], head[sub], nxt[sub]
        order[at] = rows
        fresh = np.ones(len(at), bool)
        fresh[1:] = (head[1:] != head[:-1]) | (nxt[1:] != nxt[:-1])
        new[at] = fresh
        rank[rows] = np.maximum.accumulate(np.where(fresh, at, 0))
        span *= 2
    return order


def _bound(sa, text, depth, lo, hi, wanted, right: bool):
    """Binary search in [lo, hi) of each row for a symbol at a depth."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        at = sa[np.minimum(mid, len(sa) - 1)] + depth
        have = np.where(at < len(text), text[np.minimum(at, len(text) - 1)], -1)
        go = open_ & ((have <= wanted) if right else (have < wanted))
        lo, hi = np.where(go, mid + 1, lo), np.where(open_ & ~go, mid, hi)


def search(sa: np.ndarray, text: np.ndarray, items: np.ndarray, starts: np.ndarray,
           ends: np.ndarray, needed: np.ndarray):
    """Longest match of every suffix ``items[start:end]``, and the interval of the suffix array
    at depth ``needed`` (empty if the match is shorter). ``items``: ranks, -1 for unknown."""
    n = len(starts)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(sa))
    longest, at_lo, at_hi = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    live, depth = np.arange(n), 0
    while len(live):
        live = live[starts[live] + depth < ends[live]]
        wanted = items[starts[live] + depth]
        live, wanted = live[wanted >= 0], wanted[wanted >= 0]
        a = _bound(sa, text, depth, lo[live], hi[live], wanted, False)
        b = _bound(sa, text, depth, a, hi[live], wanted, True)
        live, a, b = live[a < b], a[a < b], b[a < b]
        lo[live], hi[live] = a, b
        depth += 1
        longest[live] = depth
        here = live[needed[live] == depth]
        at_lo[here], at_hi[here] = lo[here], hi[here]
    return longest, at_lo, at_hi


class Block:
    """A block of the benchmark: the word hashes of its items, and the windows to look for."""

    def __init__(self, ids: list[str], texts: list[bytes]):
        hasher = WordHasher()
        words = [hasher(t) for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        self.ids, self.words = ids, np.concatenate([np.zeros(0, np.uint64), *words])
        end = sizes.cumsum()
        item = np.repeat(np.arange(len(ids)), sizes)
        self.start = np.arange(len(self.words))
        self.end, self.item = end[item], item
        self.longest = int(sizes.max(initial=0))
        whole = np.minimum(sizes[item], WINDOW)  # the window's length
        self.needed = np.where(self.end - self.start >= whole, whole, 0)


def match_shard(docs: list[np.ndarray], block: Block):
    """For each match of a window in a shard: document, first word, length, item; and the
    longest match of every suffix of the block."""
    sizes = np.array([len(d) + 1 for d in docs], np.int64)
    flat = np.zeros(int(sizes.sum()), np.uint64)
    first = sizes.cumsum() - sizes
    mark = np.ones(len(flat), bool)
    mark[first + sizes - 1] = False
    flat[mark] = np.concatenate([np.zeros(0, np.uint64), *docs])
    vocabulary, text = np.unique(flat[mark], return_inverse=True)
    ranks = np.zeros(len(flat), np.int64)
    ranks[mark] = text + 1  # 0 is the end mark
    at = np.searchsorted(vocabulary, block.words)
    at[at == len(vocabulary)] = 0
    known = vocabulary[at] == block.words if len(vocabulary) else np.zeros(len(at), bool)
    items = np.where(known, at + 1, -1)
    sa = suffix_array(ranks, block.longest)
    longest, lo, hi = search(sa, ranks, items, block.start, block.end, block.needed)
    count = hi - lo
    which = np.repeat(np.arange(len(count)), count)
    place = sa[np.arange(int(count.sum())) - np.repeat(count.cumsum() - count, count)
               + np.repeat(lo, count)]
    doc = np.searchsorted(first, place, side="right") - 1
    return doc, place - first[doc], block.needed[which], block.item[which], longest


def _covered(spans: np.ndarray, n_words: int) -> int:
    """Words inside any of the spans (start, length)."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, spans[:, 0], 1)
    np.add.at(edge, np.minimum(spans.sum(1), n_words), -1)
    return int((edge.cumsum()[:n_words] > 0).sum())


def find_contamination(docs: DataFrame, benchmark: DataFrame, carry: list[str],
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """``carry`` and n_words, n_hit, n_items, items_sha256, contaminated of every row, and
    ``spans``: the hit windows as pairs of int32 (first word, words)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    items = columns(benchmark, "item_id", "text").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.coalesce("text", F.lit("")).alias("text"))
    words = items.agg(F.sum(F.length("text"))).first()[0] or 0  # at least as many as words
    n_blocks = words // block_words + 1
    carried = [F.col(f"`{c}`") for c in carry]
    state = docs.select(F.col("text").alias("_text"), F.lit(b"").alias("_spans"),
                        F.lit("").alias("_items"), F.lit(0).cast("long").alias("_n"), *carried)
    schema, out = state.schema, docs.select(*carried).schema
    for name, kind in (("n_words", "long"), ("n_hit", "long"), ("n_items", "long"),
                       ("items_sha256", "string"), ("contaminated", "boolean"),
                       ("spans", "binary")):
        out = out.add(name, kind)
    for k in range(n_blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k) \
            .orderBy("item_id", "text").collect()  # one block of the query set
        block = spark.sparkContext.broadcast(([r.item_id for r in part],
                                              [r.text.encode() for r in part]))

        last = k == n_blocks - 1

        def visit(batches, block=block, last=last):
            found = _visited(batches, Block(*block.value))
            yield from (_finished(b, carry) for b in found) if last else found
        state = state.mapInArrow(visit, out if last else schema)
    return state


def _visited(batches: Iterator[pa.RecordBatch], items: Block) -> Iterator[pa.RecordBatch]:
    """The rows, shard by shard, with the block's matches added to their state."""
    hasher = WordHasher()
    for batch in batches:
        held, first = [], 0
        texts = raw_texts(batch.column(0))
        for i, t in enumerate(texts):
            held.append(hasher(t))
            if sum(map(len, held)) >= SHARD_WORDS:
                yield _shard(batch.slice(first, i + 1 - first), held, items)
                held, first = [], i + 1
        if held:
            yield _shard(batch.slice(first), held, items)


def _finished(b: pa.RecordBatch, carry: list[str]) -> pa.RecordBatch:
    """The result columns of rows that every block has visited."""
    n_hit, n_items, digest = [], [], []
    for spans, found, n in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
        n_hit.append(_covered(np.frombuffer(spans, "<i4").reshape(-1, 2), n))
        ids = sorted(set(found.split("\n")[1:]))
        n_items.append(len(ids))
        digest.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
    return pa.RecordBatch.from_arrays(
        [*b.columns[4:], b.column(3), pa.array(n_hit, pa.int64()),
         pa.array(n_items, pa.int64()), pa.array(digest, pa.string()),
         pa.array([h > 0 for h in n_hit], pa.bool_()), b.column(1)],
        [*carry, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])


def _shard(rows: pa.RecordBatch, docs: list[np.ndarray], block: Block) -> pa.RecordBatch:
    """The rows of a shard with the block's matches added to their state."""
    doc, start, length, item, _ = match_shard(docs, block)
    spans, items = rows.column(1).to_pylist(), rows.column(2).to_pylist()
    order = np.argsort(doc, kind="stable")
    cuts = np.flatnonzero(np.diff(doc[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        d = int(doc[part[0]])
        pairs = np.unique(np.stack([start[part], length[part]], 1).astype("<i4"), axis=0)
        spans[d] += pairs.tobytes()
        items[d] += "".join("\n" + block.ids[i] for i in np.unique(item[part]))
    return pa.RecordBatch.from_arrays(
        [rows.column(0), pa.array(spans, pa.binary()), pa.array(items, pa.string()),
         pa.array([len(d) for d in docs], pa.int64()), *rows.columns[4:]],
        schema=rows.schema)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"),
                               ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
