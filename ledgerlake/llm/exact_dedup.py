"""Exact duplicates against history: a minimal perfect hash over historical digests.

Every text has a SHA-256 digest of its bytes with A-Z lower-cased. The digests of history are
dealt to shards by prefix; each shard holds a minimal perfect hash (a cascade of bit arrays: a
key takes the first level where it is alone in its position, and its slot is the rank of that
bit). A slot holds the full digest, the locator of the winner and the number of copies. New
digests are looked up slot by slot and compared byte for byte: members join the slot's group,
all others form groups of their own. Of each group the row with the largest doc_id stays.

Defined cases: a null text counts as empty; a null doc_id is smaller than any other; rows that
repeat both doc_id and text are one group of which one row stays; empty tables give an empty
result; columns other than the id and the text are not read.

Scale: texts are digested where they are read; only 40-byte rows are shuffled, and equal ones
are combined before every shuffle, so a hot text is one row per task. Shards hold
``shard_digests`` distinct digests on average.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Scratch, bounded_batches, columns, documents, mix64, raw_texts

SHARD_DIGESTS = 50_000
_NULL_ID = -(1 << 63)
_INDEX = "shard int, sizes array<int>, bits binary, digests binary, winners binary, copies binary"
_SLOT = "digest binary, winner bigint, copies bigint"


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, n): how often each pair of id and digest occurs."""
    def digest(batches):
        for b in batches:
            found = [hashlib.sha256(t.lower()).digest() for t in raw_texts(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(found, pa.binary())], ["doc_id", "digest"])
    bounded_batches(docs.sparkSession)
    rows = columns(docs, id_col, text_col).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc_id"), text_col)
    return rows.mapInArrow(digest, "doc_id bigint, digest binary") \
        .groupBy("doc_id", "digest").agg(F.count("*").alias("n"))


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the largest id and the number of rows."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.sum("n").alias("copies"))


# -- the minimal perfect hash of one shard ------------------------------------------------

def _position(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level * 0x9E3779B97F4A7C15) & (2**64 - 1))
    return (mix64(keys[:, 1] ^ mix64(keys[:, 2] + salt)) % np.uint64(size)).astype(np.int64)


def _keys(digests: np.ndarray) -> np.ndarray:
    return digests.reshape(-1, 32).view("<u8")


def build_mph(digests: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Bits of all levels for distinct digests (n x 32 bytes), and the size of each level."""
    left, sizes, bits = _keys(digests), [], []
    while len(left):
        if len(sizes) > 200:
            raise ValueError("digests of one shard are not distinct")
        size = 2 * len(left) + 1
        at = _position(left, len(sizes), size)
        count = np.bincount(at, minlength=size)
        bits.append(count == 1)
        sizes.append(size)
        left = left[count[at] > 1]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def slots_of(digests: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot of each digest; -1 where no level answers (surely not a member)."""
    keys, out = _keys(digests), np.full(len(digests), -1, np.int64)
    rank, open_, first = np.cumsum(bits) - 1, np.arange(len(digests)), 0
    for level, size in enumerate(sizes):
        at = _position(keys[open_], level, size) + first
        hit = bits[at]
        out[open_[hit]] = rank[at[hit]]
        open_, first = open_[~hit], first + size
    return out


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(x) for x in column), np.uint8).reshape(-1, 32)


def _shard(n_shards: int):
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("long"),
                  F.lit(n_shards)).cast("int")


def build_index(entries: DataFrame, n_shards: int) -> DataFrame:
    """One row per shard of distinct ``(digest, winner, copies)``: hash, slots and locators."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        digests = _matrix(pdf["digest"])
        sizes, bits = build_mph(digests)
        order = np.argsort(slots_of(digests, sizes, bits))
        return pd.DataFrame({
            "shard": pdf["shard"].iloc[:1], "sizes": [sizes],
            "bits": [np.packbits(bits).tobytes()], "digests": [digests[order].tobytes()],
            "winners": [pdf["winner"].to_numpy("<i8")[order].tobytes()],
            "copies": [pdf["copies"].to_numpy("<i8")[order].tobytes()]})
    return entries.withColumn("shard", _shard(n_shards)).groupBy("shard") \
        .applyInPandas(build, _INDEX)


def resolve(new: DataFrame, index: DataFrame, n_shards: int) -> DataFrame:
    """All groups of history and of ``new`` (distinct digests): winner and copies of each."""
    def look_up(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if index.empty:
            return new[["digest", "winner", "copies"]]
        row = index.iloc[0]
        slots = _matrix([row["digests"]])
        winners = np.frombuffer(row["winners"], "<i8").copy()
        copies = np.frombuffer(row["copies"], "<i8").copy()
        rest = new[["digest", "winner", "copies"]]
        if len(new):
            sizes = [int(s) for s in row["sizes"]]
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:sum(sizes)].astype(bool)
            digests = _matrix(new["digest"])
            at = slots_of(digests, sizes, bits)
            member = at >= 0
            member[member] = (slots[at[member]] == digests[member]).all(axis=1)
            at = at[member]
            winners[at] = np.maximum(winners[at], new["winner"].to_numpy()[member])
            copies[at] += new["copies"].to_numpy()[member]
            rest = rest[~member]
        known = pd.DataFrame({"digest": [s.tobytes() for s in slots], "winner": winners,
                              "copies": copies})
        return pd.concat([known, rest], ignore_index=True)
    return new.withColumn("shard", _shard(n_shards)).groupBy("shard") \
        .cogroup(index.groupBy("shard")).applyInPandas(look_up, _SLOT)


def exact_duplicates(docs: DataFrame, is_history, shard_digests: int = SHARD_DIGESTS,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``is_history``: a condition over ``doc_id`` that marks the rows of earlier deliveries; they
    make the index, the other rows are looked up in it."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    rows = scratch.write(digest_rows(docs, id_col, text_col), "rows")
    entries = scratch.write(groups(rows.filter(is_history)), "entries")
    new = scratch.write(groups(rows.filter(~is_history)), "new")
    # a shard holds its part of both, and either may be the larger
    n_shards = max(entries.count(), new.count()) // shard_digests + 1
    index = scratch.write(build_index(entries, n_shards), "index")
    all_groups = resolve(new, index, n_shards)
    real_id = lambda c: F.when(F.col(c) != _NULL_ID, F.col(c))
    return rows.join(all_groups, "digest") \
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))) \
        .select(real_id("doc_id").alias("doc_id"), real_id("winner").alias("keep_id"),
                F.col("copies").alias("group_size"),
                ((F.col("doc_id") == F.col("winner")) & (F.col("copy") == 1)).alias("kept"),
                F.lower(F.hex("digest")).alias("text_sha256"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; the lower half of the range of doc_id is the earlier delivery."""
    docs = documents(spark, sf_dir)
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = ((low or 0) + (high or 0)) // 2
    return exact_duplicates(docs, F.col("doc_id") <= middle)


OP7_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
     g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size, sha256(t) AS text_sha256
           FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (t)
"""
