"""N-gram Jaccard join by MinHash banding.

Documents are sets of hashed 5-word shingles. Rows with the same set are one class, carried once
with its size. Bands of MinHash rows are chosen for the target recall at the threshold; classes
that meet in a band form candidate groups (connected through one star per bucket, never through
all pairs). In each group the full sets are compared exactly, block against block of about
``BLOCK`` classes as 0/1 matrices; a task returns per class the number of linked rows and one
edge to the smallest class it is connected with. These edges give the final components.

Result per row: doc_id, class_id (smallest doc_id of its component) and n_links (other rows with
a similarity of at least the threshold; copies count).

Defined cases: null and empty texts have no shingle, equal one another and nothing else; texts of
fewer than five words are one shingle; null doc_ids stay null and are larger than any other when
the class_id is taken; repeated rows count as rows; empty tables give no rows; other columns are
not read.

Scale: sets are made only for classes that are candidates. A group of k classes is k / BLOCK
rows a class and (k / BLOCK)**2 / 2 tasks, dealt by hash; nothing is capped. What is known of a
band, group or component is written as a table before its members join it: then both sides of
the join come straight from shuffles and AQE splits the members of a very large group."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import Scratch, WordHasher, bounded_batches, columns, documents, raw_texts, shingles

N_WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
BAND_ROWS = 5
BLOCK = 256
#: Shingles in one 0/1 matrix.
MATRIX_COLUMNS = 16384


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = BAND_ROWS) -> int:
    """The least number of bands with the target recall at the threshold."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def band_hashes(grams: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    """One hash per band of the MinHash rows of a set of shingles."""
    rng = np.random.default_rng(20)
    a = rng.integers(1, 1 << 63, n_bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    low = np.full(n_bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for part in np.array_split(grams, len(grams) // 2048 + 1):
        np.minimum(low, (part[:, None] * a).min(0, initial=np.iinfo(np.uint64).max), out=low)
    h = np.arange(n_bands, dtype=np.uint64)
    for k in range(rows):
        h = (h ^ low.reshape(n_bands, rows)[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _key(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, n_bands: int) -> DataFrame:
    """(doc_id, text_id, key, bands) of every row; ``key`` names the set of shingles."""
    def sign(batches):
        hasher = WordHasher()
        for b in batches:
            keys, bands = [], []
            for t in raw_texts(b.column(1)):
                grams = shingles(hasher(t), N_WORDS)
                keys.append(_key(grams))
                bands.append(band_hashes(grams, n_bands, BAND_ROWS) if len(grams) else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "text_id", "key", "bands"])
    bounded_batches(docs.sparkSession)
    return columns(docs, "doc_id", "text") \
        .select(F.col("doc_id").cast("long"), "text", text_id(F.col("text"))) \
        .mapInArrow(sign, "doc_id bigint, text_id string, key binary, bands array<bigint>")


def text_id(text: Column) -> Column:
    """What tells rows of one doc_id apart when they are found again."""
    return F.md5(F.coalesce(text, F.lit("")))


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) for all nodes of edges (a, b): alternating large and small stars."""
    def with_low(rows: DataFrame, table: str) -> DataFrame:
        """``rows`` with m, the smallest b of their a. The minima are a table, so that both sides
        of the join come straight from shuffles, and AQE can split a centre with many rows."""
        low = rows.groupBy("a").agg(F.min("b").alias("m"))
        return rows.join(scratch.write(low, table), "a")

    state = scratch.write(edges.filter("a <> b").distinct(), f"{name}-0")
    step, before = 0, None
    while True:
        step += 1
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = with_low(both, f"{name}-{step}-low").filter("b > a") \
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        large = scratch.write(large, f"{name}-{step}-large")
        joined = with_low(large, f"{name}-{step}-small")
        small = joined.select("a", F.col("m").alias("b")).unionByName(
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()
        after = scratch.write(small, f"{name}-{step}")
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        for table in (f"{step}-low", f"{step}-large", f"{step}-small", f"{step - 1}"):
            scratch.drop(f"{name}-{table}")
        if seen == before:
            break
        state, before = after, seen
    return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _blocks(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between the classes of a task, one candidate group after the other."""
    return pd.concat([_links(group, threshold) for _, group in pdf.groupby("root")])


def _links(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between classes of one group: all in one block, or of one block to the other."""
    sets = [np.frombuffer(g, np.uint64) for g in pdf["grams"]]
    n, sizes = len(sets), np.array([len(s) for s in sets])
    grams, column = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(column) > 1  # a shingle of one class alone can't meet
    number = np.cumsum(shared) - 1
    row, keep = np.repeat(np.arange(n), sizes), shared[column]
    row, column, both = row[keep], number[column[keep]], np.zeros((n, n), np.float32)
    for first in range(0, int(shared.sum()), MATRIX_COLUMNS):
        part = (column >= first) & (column < first + MATRIX_COLUMNS)
        matrix = np.zeros((n, min(MATRIX_COLUMNS, int(shared.sum()) - first)), np.float32)
        matrix[row[part], column[part] - first] = 1
        both += matrix @ matrix.T
    linked = both >= threshold * (sizes[:, None] + sizes - both) - 1e-3
    side, wide = pdf["side"].to_numpy(), pdf["cross"].to_numpy()
    linked &= ~wide[:, None] | (side[:, None] != side)
    np.fill_diagonal(linked, False)
    links = linked.astype(np.int64) @ pdf["copies"].to_numpy()
    keys, parent = pdf["key"].to_numpy(), np.arange(n)
    for _ in range(n):  # smallest index reachable through links
        low = np.minimum(parent, np.where(linked, parent, n).min(1))
        low = np.minimum(low, low[low])
        if (low == parent).all():
            break
        parent = low
    return pd.DataFrame({"key": keys, "links": links, "other": keys[parent]})


def similarity_join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL
                    ) -> DataFrame:
    """(doc_id, text_id, class_id, n_links) of every row; class_key names the component."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dup")
    signed = scratch.write(signatures(docs, bands_for(threshold, recall)), "signed")
    classes = scratch.write(signed.groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"),
        F.first("bands").alias("bands")), "classes")
    held = classes.select("key", F.explode("bands").alias("band"))
    stars = held.groupBy("band").agg(F.min("key").alias("b"), F.count("*").alias("n")) \
        .filter("n > 1").select("band", "b")
    stars = scratch.write(stars, "stars")
    rough = components(held.join(stars, "band").select(F.col("key").alias("a"), "b"),
                       scratch, "rough")
    rough = scratch.write(rough, "rough")
    wanted = rough.join(classes.select("key", "first_id", "copies"),
                        F.col("node") == F.col("key")) \
        .withColumn("id", F.coalesce("first_id", F.lit(-1 << 63)))

    def make_sets(batches):
        hasher = WordHasher()
        for b in batches:
            grams = [shingles(hasher(t), N_WORDS) for t in raw_texts(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([_key(g) for g in grams], pa.binary()),
                 pa.array([g.tobytes() for g in grams], pa.binary())], ["id", "key", "grams"])
    ids = scratch.write(wanted.select("id").distinct(), "ids")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63)).alias("id"),
                        "text").join(ids, "id", "left_semi")
    sets = texts.mapInArrow(make_sets, "id bigint, key binary, grams binary") \
        .join(wanted.select("key", "id", "root", "copies"), ["id", "key"]) \
        .dropDuplicates(["key"])
    sets = scratch.write(sets, "sets")
    widths = sets.groupBy("root").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("width"))
    widths = scratch.write(widths, "widths")
    n_small = max(1, sets.count() // BLOCK)
    tasks = sets.join(widths, "root") \
        .withColumn("i", F.pmod(F.xxhash64("key"), F.col("width")).cast("int")) \
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("width") - 1))) \
        .withColumn("cross", F.col("i") != F.col("j")) \
        .withColumn("side", F.col("i") < F.col("j")) \
        .withColumn("task", F.when(F.col("width") == 1, F.pmod(F.xxhash64("root"), F.lit(n_small)))
                    .otherwise(F.xxhash64("root"))) \
        .withColumn("lo", F.least("i", "j")).withColumn("hi", F.greatest("i", "j"))
    checked = tasks.groupBy((F.col("width") == 1).alias("small"), "task", "lo", "hi").applyInPandas(
        lambda pdf: _blocks(pdf, threshold), "key binary, links bigint, other binary")
    checked = scratch.write(checked, "checked")
    final = components(checked.select(F.col("key").alias("a"), F.col("other").alias("b")),
                       scratch, "final")
    links = checked.groupBy("key").agg(F.sum("links").alias("links"))
    named = classes.drop("bands") \
        .join(final, F.col("key") == F.col("node"), "left").join(links, "key", "left") \
        .select("key", "first_id", F.coalesce("root", "key").alias("class_key"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    named = scratch.write(named, "named")
    firsts = scratch.write(
        named.groupBy("class_key").agg(F.min("first_id").alias("class_id")), "firsts")
    named = named.join(firsts, "class_key").select("key", "class_key", "class_id", "n_links")
    return signed.select("doc_id", "text_id", "key").join(named, "key")


def one_per_group(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of each component, one row each."""
    joined = similarity_join(docs, threshold)
    winners = joined.groupBy("class_key") \
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_id")).alias("w")) \
        .select(F.col("w.doc_id").alias("_id"), F.col("w.text_id").alias("_text_id"))
    rows = docs.withColumn("_tid", text_id(F.col("text")))
    return rows.join(winners, F.col("doc_id").eqNullSafe(F.col("_id"))
                     & (F.col("_tid") == F.col("_text_id"))) \
        .dropDuplicates(["doc_id", "_tid"]).select(*docs.columns)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_join(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")
