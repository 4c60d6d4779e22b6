"""Near duplicates by SimHash and bit-sliced comparison.

A document is its words and their 3-word shingles, repeats included; bit k of its fingerprint is 1
if bit k is set in more than half of the shingles' 64-bit XXH64 hashes. Equal fingerprints are
one class. Two classes link if their fingerprints differ in at most ``RADIUS`` bits.

Which classes meet: the 64 bits are four parts; a pair of links agrees on at least two of them,
so each of the six choices of two parts deals the classes to buckets by those parts' bits. A
bucket of more than ``BLOCK`` classes is dealt again: its free bits are three parts of which a
pair agrees on at least one. After three such rounds at most ten bits are free, so that no bucket
can have more than 2**10 = ``BLOCK`` classes, whatever the data are.

How they are compared: the classes of a task's buckets are lanes, 64 to a machine word, stored
as bit planes: plane k holds bit k of all lanes. One fingerprint meets 64 lanes at a time. Plane by
plane the bits that differ are added to bit-sliced counters with carries kept apart (a carry-save
adder); the counters start so high that the carry out of the last one says the radius is
exceeded. After every ``PLANES`` planes, words of which all lanes are over are abandoned.

A task returns one edge of every class to the smallest class that its bucket connects it with;
stars over all edges give the components.

Defined cases: null and empty texts have no words and the fingerprint zero, which links like any
other; fewer than three words are one shingle; null doc_ids stay null and count as larger than
any other (a component of nulls alone has no id); repeated rows count as rows; an empty table
gives no rows; other columns are not read.

Scale: texts are read once, where they lie; a class is 8 bytes and goes to six buckets, the
classes of large buckets to three more a round. Equal fingerprints are combined before every
shuffle. Pairs are bits in a task's memory, at most ``SLICE`` at a time, and are never rows."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Scratch, bounded_batches, columns, documents, raw_texts
from .graph import star_components

N_WORDS = 3
SEED = 42
RADIUS = 2
PARTS = 4
BLOCK = 1024
PLANES = 8
#: Rows that are dealt to one task of comparisons, on average.
TASK_ROWS = 1 << 16
#: Pairs of lanes that are compared at once.
SLICE = 1 << 22
_CHUNK = 1 << 16


# -- fingerprints -----------------------------------------------------------------------------

def fingerprint(text: bytes) -> int:
    words = text.lower().split()  # bytes: only A-Z, and only blanks of ASCII
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(N_WORDS, len(words))
    start = np.concatenate([[0], end[:-1] + 1])[:len(words) - width + 1].tolist()
    end = end[width - 1:].tolist()
    total = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(start), _CHUNK):
        h = np.array([digest(joined[s:e], SEED)
                      for s, e in zip(start[k:k + _CHUNK], end[k:k + _CHUNK])], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(start), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed 64-bit number."""
    def sign(batches):
        for b in batches:
            fps = np.array([fingerprint(t) for t in raw_texts(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
    bounded_batches(docs.sparkSession)
    return columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text") \
        .mapInArrow(sign, "doc_id bigint, fp bigint")


# -- which classes meet -----------------------------------------------------------------------

def _mask(bits) -> int:
    """A set of bit numbers as a signed 64-bit number."""
    return int(np.array(sum(1 << b for b in bits), np.uint64).view(np.int64))


def first_masks() -> list[int]:
    """The bits that a pair may be asked to agree on: all parts but ``RADIUS``."""
    parts = np.array_split(np.arange(64), PARTS)
    return [_mask(np.concatenate(kept).tolist())
            for kept in itertools.combinations(parts, PARTS - RADIUS)]


def finer_masks(mask: int) -> list[int]:
    """The bits of ``mask`` and one of ``RADIUS + 1`` parts of the others."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | _mask(part.tolist()) for part in np.array_split(free, RADIUS + 1)]


def free_bits(mask: int) -> int:
    return 64 - (mask & (1 << 64) - 1).bit_count()


def _deal(rows: DataFrame, masks) -> DataFrame:
    """(fp, mask, key): each fp once for each of its ``masks`` (an array column)."""
    return rows.select("fp", F.explode(masks).alias("mask")) \
        .withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))


# -- bit-sliced comparison --------------------------------------------------------------------

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows of words: bit j of word w of row k is bit k of fingerprint 64 * w + j."""
    bits = np.zeros((-(-len(fps) // 64) * 64, 64), np.uint8)
    bits[:len(fps)] = np.unpackbits(
        fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def links(fps: np.ndarray, first: np.ndarray, radius: int = RADIUS
          ) -> tuple[np.ndarray, np.ndarray]:
    """Lanes (a, b), b < a, within the radius; lane a meets the lanes from ``first[a]`` to a."""
    lane = np.arange(len(fps))
    n_words = np.where(first < lane, (lane - 1) // 64 - first // 64 + 1, 0)
    query = np.repeat(lane, n_words)
    word = np.arange(n_words.sum()) - np.repeat(np.cumsum(n_words) - n_words, n_words) \
        + first[query] // 64
    # lanes of a word that are no partners are over from the start
    low = np.maximum(first[query] - 64 * word, 0).astype(np.uint64)
    high = np.maximum(64 * word + 64 - query, 0).astype(np.uint64)
    over = ~((_ALL << low) & (_ALL >> high))
    planes = bit_planes(fps)
    start = (1 << radius.bit_length()) - 1 - radius
    counters = [np.full(len(query), _ALL if start >> k & 1 else 0, np.uint64)
                for k in range(radius.bit_length())]
    for k in range(64):
        if k and k % PLANES == 0:  # abandon words whose lanes are all over
            alive = over != _ALL
            query, word, over = query[alive], word[alive], over[alive]
            counters = [c[alive] for c in counters]
        bit = (fps[query] >> np.uint64(k)) & np.uint64(1)
        carry = planes[k][word] ^ (np.uint64(0) - bit)
        for c in counters:
            c ^= carry  # sum without carry; where the old bit was set, it carries on
            carry &= ~c
        over |= carry
    hits = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8),
                         axis=1, bitorder="little")
    at, lane = np.nonzero(hits)
    return query[at], 64 * word[at] + lane


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest lane that each of n lanes is connected with by the links (a, b)."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _edges(pdf: pd.DataFrame) -> pd.DataFrame:
    """One edge of each class to the smallest lane that its bucket connects it with."""
    pdf = pdf.sort_values(["mask", "key", "fp"])
    fps = pdf["fp"].to_numpy()
    same = (pdf["mask"].to_numpy()[1:] == pdf["mask"].to_numpy()[:-1]) \
        & (pdf["key"].to_numpy()[1:] == pdf["key"].to_numpy()[:-1])
    begin = np.concatenate([[0], np.flatnonzero(~same) + 1])
    sizes = np.diff(np.append(begin, len(fps)))
    part = np.cumsum(sizes.astype(np.int64) ** 2) // SLICE
    out = []
    for p in np.unique(part):  # whole buckets, about SLICE pairs at a time
        own = part == p
        lo, hi = begin[own][0], begin[own][-1] + sizes[own][-1]
        first = np.repeat(begin[own] - lo, sizes[own])
        some = fps[lo:hi]
        root = roots(hi - lo, *links(some.view(np.uint64), first))
        moved = np.flatnonzero(root != np.arange(hi - lo))
        out.append(pd.DataFrame({"a": some[moved], "b": some[root[moved]]}))
    return pd.concat(out)


def near_edges(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that connect all fingerprints of ``classes`` (fp) within the radius."""
    masks, found, k = first_masks(), None, 0
    held = _deal(classes.select("fp"), F.array(*map(F.lit, masks)))
    while True:
        sizes = scratch.write(held.groupBy("mask", "key").agg(F.count("*").alias("n"))
                              .filter("n > 1"), f"sizes-{k}")
        met = scratch.write(held.join(sizes, ["mask", "key"]), f"met-{k}")
        fits = met.filter(F.col("n") <= BLOCK)
        n_tasks = max(1, fits.count() // TASK_ROWS)
        edges = fits.groupBy(F.pmod(F.xxhash64("mask", "key"), F.lit(n_tasks)).alias("task")) \
            .applyInPandas(_edges, "a bigint, b bigint").distinct()
        edges = scratch.write(edges, f"edges-{k}")
        found = edges if found is None else found.unionByName(edges)
        wide = met.filter(F.col("n") > BLOCK)
        if wide.isEmpty():  # as it must be once no more than log2(BLOCK) bits are free
            return found
        finer = {m: finer_masks(m) for m in masks}
        table = F.create_map(*[x for m, parts in finer.items() for x in
                               (F.lit(m), F.array(*map(F.lit, parts)))])
        held = _deal(wide.select("fp", "mask").withColumn("finer", table[F.col("mask")]),
                     F.col("finer")).distinct()
        masks, k = sorted({m for parts in finer.values() for m in parts}), k + 1


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    scratch = Scratch(docs.sparkSession, "simhash")
    signed = scratch.write(fingerprints(docs), "signed")
    classes = scratch.write(signed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    nodes = star_components(near_edges(classes, scratch), scratch, "stars")
    linked = scratch.write(nodes.join(classes, F.col("node") == F.col("fp"))
                           .select("fp", "root", "first_id"), "linked")
    firsts = scratch.write(linked.groupBy("root").agg(F.min("first_id").alias("least")), "firsts")
    names = classes.join(linked.join(firsts, "root").select("fp", "least"), "fp", "left") \
        .select("fp", F.coalesce("least", "first_id").alias("component_id"))
    names = scratch.write(names, "names")
    return signed.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
