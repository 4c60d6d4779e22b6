"""Repeated byte strings by merged Burrows-Wheeler transforms.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document
with a smaller doc_id, or earlier in the same one. Strings never cross documents.

1. Partition. Every window of ``LENGTH`` bytes is owned by its minimizer, the least hash of the
   ``GRAM``-byte strings in it; consecutive windows of one minimizer form a piece. Equal windows
   have equal minimizers, so a repeated string always meets in one bucket.
2. Collapse. Equal pieces are one piece with its earliest place; all later places are removed.
3. Merge. Different pieces with a minimizer in common, whose surroundings of it agree far enough
   for a common window, go to their bucket as texts. They are cut into shards; each shard gets a suffix array and its Burrows-Wheeler transform. The transforms
   are merged by interleave refinement: from the order by h characters, the character before
   each suffix gives the order by h + 1, until ``LENGTH``; no suffix is sorted again. A boundary
   that appears in round h is a common prefix of h - 1 characters, and what no boundary has
   parted after ``LENGTH`` rounds is a repeated interval: its earliest window stays.
4. The removed windows of each document are joined to its text.

Defined cases: null and empty texts have no bytes; texts under ``LENGTH`` bytes keep all; null
doc_ids come first; a document is a doc_id with the hash of its text, in this order, so different
rows that share a doc_id are documents of their own, while equal rows are one document and each of
them loses the same bytes; empty tables give no rows; other columns are not read.

Pieces compare by 64-bit hashes (a wrong match has a chance of about 2**-64 a pair) after an
equal 48-bit minimizer."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import (
    _BASE, _INVERSE, Scratch, _powers, bounded_batches, columns, documents, mix64, raw_texts,
)
from .decontaminate import suffix_array

LENGTH = 100
GRAM = 32
SHARD_BYTES = 1 << 15
BUCKET_BYTES = 1 << 18  # a bucket of the merge, small enough for a core's cache
DEAL_BYTES = 1 << 25    # text whose pieces make one bucket
_HOLD = 500_000  # pieces a task collects before it deals them to buckets
_NULL_ID = -(1 << 63)
_NEAR = 4  # strings around a minimizer, one of which two pieces with a common window share
_PIECE = np.dtype([("anchor", "<u8"), ("piece", "<u8"), ("doc", "<i8"), ("key", "<i8"),
                   ("start", "<i4"), ("run", "<i4"), ("own", "<u1"), ("near", "<u4", (_NEAR,))])


class Pieces:
    """The pieces of texts."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, text: bytes, doc: int, key: int = 0) -> np.ndarray:
        n, k = len(text), self.gram
        if n < self.length:
            return np.zeros(0, _PIECE)
        if len(self.up) <= n:
            size = max(1 << 16, 2 * n)
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * self.up[:n],
                  out=total[1:])
        h = mix64((total[k:] - total[:-k]) * self.down[:n - k + 1])
        h = (h & np.uint64(0xFFFFFFFFFFFF0000)) | \
            (np.arange(len(h), dtype=np.uint64) & np.uint64(0xFFFF))
        width, low, wide = self.length - k + 1, h, 1
        while 2 * wide <= width:
            low, wide = np.minimum(low[:-wide], low[wide:]), 2 * wide
        if wide < width:
            low = np.minimum(low[:len(low) - (width - wide)], low[width - wide:])
        anchor = low >> np.uint64(16)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.concatenate([first[1:], [len(anchor)]]) - 1
        out = np.zeros(len(first), _PIECE)
        out["anchor"], out["doc"], out["key"], out["start"] = anchor[first], doc, key, first
        out["run"] = last - first + 1
        end = last + self.length
        out["piece"] = mix64((total[end] - total[first]) * self.down[first]
                             + (end - first).astype(np.uint64))
        # a minimizer twice: it may repeat in itself (or the count of positions starts again)
        out["own"] = (low[first] != low[last]) | (first >> 16 != (end - k) >> 16)
        at = first + ((low[first].astype(np.int64) - first) & 0xFFFF)
        edges = np.arange(_NEAR + 1) * width // _NEAR
        for i, (near, far) in enumerate(zip(edges[:-1], edges[1:])):
            # in every window with at least ``near`` and under ``far`` bytes before the minimizer
            a, z = at - near, at + self.length - far + 1
            inside = (a >= first) & (z <= end)
            a, z = a[inside], z[inside]
            out["near"][inside, i] = mix64((total[z] - total[a]) * self.down[a]) | np.uint64(1)
        return out


def collapse(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces at their earliest place, and the later places of equal ones; both by minimizer."""
    p = p[np.lexsort((p["start"], p["key"], p["doc"], p["piece"], p["anchor"]))]
    new = np.ones(len(p), bool)
    new[1:] = (p["anchor"][1:] != p["anchor"][:-1]) | (p["piece"][1:] != p["piece"][:-1])
    # equal places (repeated rows) are not later
    head = np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))
    later = ~new & ((p["doc"] != p["doc"][head]) | (p["key"] != p["key"][head])
                    | (p["start"] != p["start"][head]))
    return p[new], p[later]


def _pack(p: np.ndarray) -> bytes:
    """Column by column, in order of place, so that blocks compress."""
    p = p[np.lexsort((p["start"], p["key"], p["doc"]))]
    return b"".join(np.ascontiguousarray(p[f]).tobytes() for f in _PIECE.names)


def _unpack(blob: bytes) -> np.ndarray:
    out = np.zeros(len(blob) // _PIECE.itemsize, _PIECE)
    at = 0
    for f in _PIECE.names:
        size = _PIECE[f].itemsize * len(out)
        out[f] = np.frombuffer(blob[at:at + size], _PIECE[f])
        at += size
    return out


def deal(docs: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, later, pieces): the pieces of all texts by bucket, collapsed per task."""
    def cut(batches):
        pieces, held, n = Pieces(), [], 0
        schema = pa.schema([("bucket", pa.int32()), ("later", pa.bool_()),
                            ("pieces", pa.binary())])

        def dealt():
            for later, p in enumerate(collapse(np.concatenate(held))):
                bucket = (p["anchor"] % np.uint64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
                some = [b for b in range(n_buckets) if cuts[b] < cuts[b + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([bool(later)] * len(some), pa.bool_()),
                     pa.array([_pack(p[order[cuts[b]:cuts[b + 1]]]) for b in some],
                              pa.binary())], schema=schema)
        for b in batches:
            for i, key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                 raw_texts(b.column(2))):
                held.append(pieces(t, i, key))
                n += len(held[-1])
                if n >= _HOLD:
                    yield from dealt()
                    held, n = [], 0
        if held:
            yield from dealt()
    return docs.mapInArrow(cut, "bucket int, later boolean, pieces binary")


def _by_doc(p: np.ndarray, part: bool) -> pd.DataFrame:
    """One row per document: its places as pairs (start, run), and their minimizers."""
    p = p[np.lexsort((p["start"], p["key"], p["doc"]))]
    cuts = np.flatnonzero((np.diff(p["doc"]) != 0) | (np.diff(p["key"]) != 0)) + 1
    groups = np.split(p, cuts) if len(p) else []
    pairs = [np.stack([g["start"], g["run"]], 1).astype("<i4").tobytes() for g in groups]
    return pd.DataFrame({"doc_id": np.array([g["doc"][0] for g in groups], np.int64),
                         "key": np.array([g["key"][0] for g in groups], np.int64), "part": part,
                         "spans": pairs, "anchors": [g["anchor"].tobytes() for g in groups]})


def settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: places to remove (part: false) and pieces to merge (part: true)."""
    later = pdf["later"].to_numpy(bool)
    gone = [_unpack(b) for b in pdf["pieces"][later]]
    first, more = collapse(np.concatenate(
        [np.zeros(0, _PIECE), *[_unpack(b) for b in pdf["pieces"][~later]]]))
    return pd.concat([_by_doc(np.concatenate([more, *gone]), False),
                      _by_doc(first[may_share(first)], True)], ignore_index=True)


def may_share(p: np.ndarray) -> np.ndarray:
    """Which of different pieces, sorted by minimizer, may have a window in common with another
    of their minimizer, or with themselves. A common window holds one of the ``near`` strings of
    both, so pieces without a partner in any of them are out; where a piece has its minimizer
    twice, all pieces of that minimizer stay."""
    same = np.zeros(len(p), bool)
    same[1:] = p["anchor"][1:] == p["anchor"][:-1]
    same[:-1] |= same[1:]
    same |= p["own"] > 0
    if not same.all():
        same[same] = may_share(p[same])
        return same
    group = np.cumsum(np.concatenate([[0], p["anchor"][1:] != p["anchor"][:-1]])[:len(p)])
    keep = np.bincount(group, p["own"], minlength=1)[group] > 0
    for i in range(_NEAR):
        near = p["near"][:, i]
        order = np.lexsort((near, group))
        equal = (group[order][1:] == group[order][:-1]) & (near[order][1:] == near[order][:-1]) \
            & (near[order][1:] > 0)
        keep[order[1:][equal]] = keep[order[:-1][equal]] = True
    return keep


def merge_transforms(shards: list[np.ndarray], length: int,
                     repeated: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Merge the transforms of shards (bytes, each text ended by 0xFF). Returns the suffixes as
    places in the joined shards, in order of their first ``length`` characters, and where a new
    interval of equal prefixes begins. ``repeated``: only intervals of two and more strings inside
    texts; a suffix alone in its interval is settled, as all that it ends, and so is one before
    which a text ends, so neither enters a later round."""
    offsets = np.cumsum([0, *map(len, shards)])
    kind = np.int32 if offsets[-1] < 1 << 31 else np.int64
    transform = np.empty(offsets[-1], np.uint8)     # the character before each suffix
    before = np.empty(offsets[-1], kind)            # the rank of the suffix that begins there
    place = np.empty(offsets[-1], np.int64)
    for at, shard in zip(offsets, shards):
        sa = suffix_array(shard.astype(np.int64), length)
        rank = np.empty(len(sa), np.int64)
        rank[sa] = np.arange(len(sa))
        previous = (sa - 1) % len(sa)
        transform[at:at + len(sa)] = shard[previous]
        before[at:at + len(sa)] = rank[previous] + at
        place[at:at + len(sa)] = sa + at
    suffix = np.arange(offsets[-1], dtype=kind)      # ranks in the shards, interleaved
    block = np.zeros(offsets[-1], kind)
    for _ in range(length):
        char = transform[suffix]
        if repeated:
            inside = char != 0xFF
            char, suffix, block = char[inside], suffix[inside], block[inside]
        order = np.argsort(char, kind="stable")      # a counting sort of bytes
        char, source = char[order], block[order]
        suffix = before[suffix[order]]
        new = np.ones(len(order), bool)
        new[1:] = (char[1:] != char[:-1]) | (source[1:] != source[:-1])
        block = np.cumsum(new, dtype=kind)
        if repeated:
            shared = ~new
            shared[:-1] |= ~new[1:]
            suffix, block, new = suffix[shared], block[shared], new[shared]
    return place[suffix], new


def merge_bucket(pdf: pd.DataFrame, length: int = LENGTH) -> pd.DataFrame:
    """Repeated windows among the pieces of one bucket (doc_id, key, start, text)."""
    pdf = pdf.sort_values(["doc_id", "key", "start"])
    texts = [bytes(t) for t in pdf["text"]]
    shards, held, size = [], [], 0
    for t in texts:
        held.append(t + b"\xff")
        size += len(t) + 1
        if size >= SHARD_BYTES:
            shards.append(np.frombuffer(b"".join(held), np.uint8))
            held, size = [], 0
    if held:
        shards.append(np.frombuffer(b"".join(held), np.uint8))
    sizes = np.array([len(t) + 1 for t in texts])
    first = sizes.cumsum() - sizes
    place, new = merge_transforms(shards, length, repeated=True)
    interval = np.cumsum(new)
    piece = np.searchsorted(first, place, side="right") - 1
    offset = place - first[piece]
    doc, key = (pdf[c].to_numpy(np.int64)[piece] for c in ("doc_id", "key"))
    start = pdf["start"].to_numpy(np.int64)[piece] + offset
    order = np.lexsort((start, key, doc, interval))
    interval, doc, key, start = interval[order], doc[order], key[order], start[order]
    head = np.ones(len(order), bool)
    head[1:] = interval[1:] != interval[:-1]
    earliest = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    later = (doc != doc[earliest]) | (key != key[earliest]) | (start != start[earliest])
    out = np.zeros(int(later.sum()), _PIECE)
    out["doc"], out["key"], out["start"], out["run"] = doc[later], key[later], start[later], 1
    return _by_doc(out, False)


_SPANS = "doc_id bigint, key bigint, part boolean, spans binary, anchors binary"


def repeated_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, key, spans) of the windows to remove; several rows a document."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // DEAL_BYTES + 1)
    settled = scratch.write(
        deal(docs, n_buckets).groupBy("bucket").applyInPandas(settle, _SPANS), "settled")
    parts = settled.filter("part")
    bytes_ = parts.agg(F.sum(F.octet_length("anchors"))).first()[0] or 0
    n_merge = max(n_buckets, bytes_ // 8 * (LENGTH + GRAM) // BUCKET_BYTES + 1)
    wanted = parts.groupBy("doc_id", "key").agg(F.collect_list(F.struct("spans", "anchors")).alias("p"))

    def take(batches):
        for b in batches:
            rows = []
            for i, key, t, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                        raw_texts(b.column(2)), b.column(3).to_pylist()):
                for p in parts:
                    spans = np.frombuffer(p["spans"], "<i4").reshape(-1, 2)
                    for (s, n), a in zip(spans, np.frombuffer(p["anchors"], "<u8")):
                        if s + n - 1 + LENGTH <= len(t):
                            rows.append((int(a) % n_merge, i, key, int(s),
                                         t[s:s + n - 1 + LENGTH]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                ["bucket", "doc_id", "key", "start", "text"])
    texts = docs.join(wanted, ["doc_id", "key"]).select("doc_id", "key", "text", "p") \
        .mapInArrow(take, "bucket bigint, doc_id bigint, key bigint, start int, text binary")
    merged = texts.groupBy("bucket").applyInPandas(lambda pdf: merge_bucket(pdf), _SPANS)
    return settled.filter("NOT part").select("doc_id", "key", "spans") \
        .unionByName(merged.select("doc_id", "key", "spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept`` (the remaining bytes)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = columns(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc_id"),
        F.xxhash64("text").alias("key"), "text")
    scratch = Scratch(spark, "suffix-dedup")
    spans = scratch.write(repeated_spans(docs, scratch), "spans")
    scratch.drop("settled")
    spans = spans.groupBy("doc_id", "key").agg(F.collect_list("spans").alias("spans"))

    def remove(batches):
        for b in batches:
            rows = []
            for i, t, found in zip(b.column(0).to_pylist(), raw_texts(b.column(1)),
                                   b.column(2).to_pylist()):
                edge = np.zeros(len(t) + 2, np.int64)
                for blob in found or []:
                    s = np.frombuffer(blob, "<i4").reshape(-1, 2)
                    s = s[s[:, 0] + s[:, 1] - 1 + LENGTH <= len(t)]
                    np.add.at(edge, s[:, 0] + 1, 1)
                    np.add.at(edge, s[:, 0] + s[:, 1] + LENGTH, -1)
                gone = edge[:-1].cumsum() > 0
                kept = np.frombuffer(t, np.uint8)[~gone[1:]].tobytes()
                rows.append((None if i == _NULL_ID else i, len(t), int(gone.sum()),
                             int((gone[1:] & ~gone[:-1]).sum()),
                             hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)
    return docs.join(spans, ["doc_id", "key"], "left").select("doc_id", "text", "spans").mapInArrow(
        remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                "kept_sha256 string, kept binary")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("kept")
