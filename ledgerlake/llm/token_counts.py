"""Edit-aware token counts.

A text is cut into leaves where a space or line end follows another character: the tokenizer's
pattern never joins text across such a place, whatever stands around it, so the counts of leaves
add up. Per document the leaf lengths and a segment tree of token counts are kept. An edit
touches the leaves from the one with the character before it to the one with the character
after it; only this region is encoded again, its count goes to the region's first leaf, the
others become empty, and the sums above them are updated.

Defined cases: null and empty texts have one empty leaf and no tokens; rows that share a doc_id
are told apart by the MD5 of their text, and full repeats share their edits; overlapping edits of
a document apply from left to right, later ones that begin inside an earlier one are ignored;
edits of unknown documents are ignored; edits beyond the end of a text are cut to it; other
columns are not read.

Scale: trees are made where texts are read (about two numbers per ``LEAF`` characters); only
rows with edits meet their text again, by one shuffle on the id."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Scratch, bounded_batches, columns, documents

LEAF = 256
_CUT = re.compile(r"(?<=\S)[ \n]")
_TREE = "doc_id bigint, text_id string, n_tokens bigint, lengths array<int>, tree array<int>"
# Personal data that the query's edits replace.
REDACTIONS = {
    "<EMAIL>": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "<PHONE>": r"\+\d{1,3} ?\(\d{2,4}\) ?\d{3}-\d{4}",
    "<IP>": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
}


class Counter:
    """Token counts of the public byte-level vocabulary."""

    def __init__(self, path: str, pattern: str):
        import base64
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={})

    def __call__(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))


def default_counter() -> Counter:
    import public_tokenizers
    return Counter(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def cut_leaves(text: str, leaf: int = LEAF) -> list[int]:
    """Lengths of the leaves of a text."""
    places, at = [0], _CUT.search(text, leaf)
    while at:
        places.append(at.start())
        at = _CUT.search(text, at.start() + leaf)
    return np.diff([*places, len(text)]).tolist()


def build_tree(counts: list[int]) -> np.ndarray:
    """Sums in heap order: node 1 is the whole, node k has the children 2 k and 2 k + 1."""
    width = 1 << max(0, len(counts) - 1).bit_length()
    tree = np.zeros(2 * width, np.int64)
    tree[width:width + len(counts)] = counts
    for k in range(width - 1, 0, -1):
        tree[k] = tree[2 * k] + tree[2 * k + 1]
    return tree


def set_leaf(tree: np.ndarray, leaf: int, count: int) -> None:
    node = len(tree) // 2 + leaf
    change = count - tree[node]
    while node and change:
        tree[node] += change
        node //= 2


def edit(text: str, lengths: list[int], tree: np.ndarray,
         edits: list[tuple[int, int, str]], count: Counter) -> tuple[np.ndarray, int, int]:
    """The tree after the edits (begin, end, replacement); how many applied, and how many
    characters were encoded for them."""
    tree, ends = tree.copy(), np.cumsum(lengths)
    regions: list[list] = []  # first leaf, last leaf, edits
    done = applied = 0
    for begin, end, new in sorted(edits):
        begin, end = min(begin, len(text)), min(max(begin, end), len(text))
        if begin < done:
            continue
        done, applied = end, applied + 1
        leaf = lambda at: min(int(np.searchsorted(ends, at, side="right")),
                              len(lengths) - 1)
        first, last = leaf(max(0, begin - 1)), leaf(end)
        if regions and first <= regions[-1][1]:
            regions[-1][1] = max(last, regions[-1][1])
            regions[-1][2].append((begin, end, new))
        else:
            regions.append([first, last, [(begin, end, new)]])
    encoded = 0
    for first, last, some in regions:
        at, parts = int(ends[first] - lengths[first]), []
        for begin, end, new in some:
            parts += [text[at:begin], new]
            at = end
        region = "".join([*parts, text[at:int(ends[last])]])
        encoded += len(region)
        set_leaf(tree, first, count(region))
        for k in range(first + 1, last + 1):
            set_leaf(tree, k, 0)
    return tree, applied, encoded


def _with_text_id(docs: DataFrame) -> DataFrame:
    return columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("text_id", F.md5("text"))


def _with_row(df: DataFrame) -> DataFrame:
    """One key for (doc_id, text_id), so that grouping and joining share a partitioning."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return df.withColumn("_row", F.concat_ws(" ", doc_id, "text_id"))


def count_trees(docs: DataFrame, counter=default_counter) -> DataFrame:
    """(doc_id, text_id, n_tokens, lengths, tree) of every row."""
    def build(batches):
        count = counter()
        for b in batches:
            lengths, trees = [], []
            for t in b.column(2).to_pylist():
                cut, at, counts = cut_leaves(t), 0, []
                for n in cut:
                    counts.append(count(t[at:at + n]))
                    at += n
                lengths.append(cut)
                trees.append(build_tree(counts))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([int(t[1]) for t in trees], pa.int64()),
                 pa.array(lengths, pa.list_(pa.int32())),
                 pa.array(trees, pa.list_(pa.int32()))],
                ["doc_id", "text_id", "n_tokens", "lengths", "tree"])
    bounded_batches(docs.sparkSession)
    return _with_text_id(docs).select("doc_id", "text_id", "text").mapInArrow(build, _TREE)


def apply_edits(docs: DataFrame, trees: DataFrame, edits: DataFrame, counter=default_counter
                ) -> DataFrame:
    """The trees of the edited rows after ``edits`` (doc_id, text_id, begin, end, replacement),
    with n_edits and n_encoded."""
    def run(batches):
        count = counter()
        for b in batches:
            rows = [edit(r["text"], r["lengths"], np.array(r["tree"], np.int64),
                         [(e["begin"], e["end"], e["replacement"]) for e in r["edits"]], count)
                    for r in b.select(["text", "lengths", "tree", "edits"]).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([int(t[1]) for t, _, _ in rows], pa.int64()),
                 b.column(3), pa.array([t for t, _, _ in rows], pa.list_(pa.int32())),
                 pa.array([n for _, n, _ in rows], pa.int64()),
                 pa.array([n for _, _, n in rows], pa.int64())],
                ["doc_id", "text_id", "n_tokens", "lengths", "tree", "n_edits", "n_encoded"])
    bounded_batches(docs.sparkSession)
    by_row = _with_row(edits).groupBy("_row").agg(
        F.collect_set(F.struct("begin", "end", "replacement")).alias("edits"))
    held = _with_row(trees).select("_row", "lengths", "tree").dropDuplicates(["_row"])
    found = _with_row(_with_text_id(docs)).dropDuplicates(["_row"]) \
        .join(by_row, "_row").join(held, "_row")
    return found.select("doc_id", "text_id", "text", "lengths", "tree", "edits") \
        .mapInArrow(run, _TREE + ", n_edits bigint, n_encoded bigint")


def redactions(docs: DataFrame, patterns: dict[str, str] = REDACTIONS) -> DataFrame:
    """Edits (doc_id, text_id, begin, end, replacement) that replace each match."""
    compiled = [(new, re.compile(p)) for new, p in patterns.items()]

    def find(batches):
        for b in batches:
            rows = [(i, k, m.start(), m.end(), new)
                    for i, k, t in zip(*(c.to_pylist() for c in b.columns))
                    for new, p in compiled for m in p.finditer(t)]
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                ["doc_id", "text_id", "begin", "end", "replacement"])
    bounded_batches(docs.sparkSession)
    return _with_text_id(docs).select("doc_id", "text_id", "text").mapInArrow(
        find, "doc_id bigint, text_id string, begin int, end int, replacement string")


def with_matches(docs: DataFrame, patterns: dict[str, str] = REDACTIONS) -> DataFrame:
    """(doc_id, text) of the rows that ``redactions`` edits: no other text has to move."""
    compiled = [re.compile(p) for p in patterns.values()]

    def keep(batches):
        for b in batches:
            yield b.filter(pa.array([any(p.search(t) for p in compiled)
                                     for t in b.column(1).to_pylist()], pa.bool_()))
    bounded_batches(docs.sparkSession)
    return _with_text_id(docs).select("doc_id", "text") \
        .mapInArrow(keep, "doc_id bigint, text string")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents before and after personal data is replaced."""
    docs = documents(spark, sf_dir)
    scratch = Scratch(spark, "token-counts")
    trees = scratch.write(count_trees(docs), "trees")
    after = apply_edits(with_matches(docs), trees, redactions(docs)) \
        .select(F.col("doc_id").alias("_id"), F.col("text_id").alias("_tid"),
                F.col("n_tokens").alias("_after"), "n_edits", "n_encoded")
    rows = trees.select("doc_id", "text_id", "n_tokens")
    return rows.join(after, F.col("doc_id").eqNullSafe(F.col("_id"))
                     & (F.col("text_id") == F.col("_tid")), "left") \
        .select("doc_id", "n_tokens", F.coalesce("_after", "n_tokens").alias("n_tokens_after"),
                F.coalesce("n_edits", F.lit(0)).alias("n_edits"),
                F.coalesce("n_encoded", F.lit(0)).alias("n_chars_encoded"))
