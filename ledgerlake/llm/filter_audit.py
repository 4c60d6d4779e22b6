"""Filter interaction audit by incremental retraction streaming.

Five filters are judged on every document; the set of those it fails is its mask. Filter E (the
text is that of a document with a smaller id) depends on all other documents. So the files of the
table come as available-now micro-batches, and the state of a text is the smallest id seen with
it and the counters of that id's rows. All rows are first counted without E. When a text comes
again, the rows with the larger id are retracted from their mask and counted with E; if the new
id is the smaller one, these are the rows that were counted in an earlier batch. Each batch
writes its changes to a log of counters by part, mask and labels; a batch that is run again
replaces its own. After the last batch the sum of the log is exact, and every order of the
filters is read off the counts of the (at most 32) masks of a part.

Defined cases: a null text counts as empty; a null source as the part of the empty string; rows
without an id neither fail E nor make others fail it; rows that repeat the smallest id of a text
all pass E; a document is good (toxic) if any of its labels says 1; an empty table gives no rows;
columns other than id, text and source are not read.

Scale: texts are read once and become a digest. A task combines its equal rows before the labels
are joined, and afterwards hands on each text once, with its smallest id only, since all others
are known to fail E: a text that a third of the documents share is one row a task. Rows without an
id are dealt at random to join the labels. A call of the state function costs milliseconds, so
the texts' states are kept in lots of about ``LOT_TEXTS`` texts by hash, and a call sees one lot.
State is held by RocksDB on the executors, with its change log in the shared checkpoint folder."""

from __future__ import annotations

import hashlib
import itertools
from collections import defaultdict
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Scratch, bounded_batches, documents, raw_texts

FILTERS = "ABCDE"
E_BIT = 1 << FILTERS.index("E")
#: The files of a table are dealt to about so many micro-batches.
BATCHES = 4
#: Texts whose state is kept together, on average.
LOT_TEXTS = 2000
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"#$%&*|"
_ROWS = "doc_id bigint, part string, key binary, mask int, n bigint"
_CHANGES = "part string, mask int, good boolean, toxic boolean, n bigint"
_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # a store is small, so no disk is reserved for its logs
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def mask_of(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words = text.split()  # bytes: blanks of ASCII only
    n_chars = len(text.decode("utf-8", "replace"))
    fails = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * (len(text) - len(text.translate(None, _UPPER))) > 2 * n_chars,
        len(text) != len(text.translate(None, _MARKS)),
    )
    return sum(1 << k for k, failed in enumerate(fails) if failed)


def _judge(batches):
    """(doc_id, part, key, mask, n): the equal rows of a task are one."""
    seen = defaultdict(int)
    for b in batches:
        for doc_id, part, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                      raw_texts(b.column(2))):
            seen[doc_id, part, hashlib.sha256(text).digest(), mask_of(text)] += 1
    yield from _batches([(*row, n) for row, n in seen.items()], pa.schema(
        [("doc_id", pa.int64()), ("part", pa.string()), ("key", pa.binary()),
         ("mask", pa.int32()), ("n", pa.int64())]))


def _batches(rows, schema):
    for k in range(0, len(rows), 10_000):
        part = list(zip(*rows[k:k + 10_000]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(part, schema)], schema=schema)


_LIGHT = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("part", pa.string()),
                    ("mask", pa.int32()), ("good", pa.bool_()), ("toxic", pa.bool_()),
                    ("n", pa.int64())])
_LIGHT_DDL = "key binary, doc_id bigint, part string, mask int, good boolean, toxic boolean, n bigint"


def _combine(batches):
    """Of each text the rows of the task's smallest id, and counters of all rows (those with a
    larger id with E). Counters have a key that is no digest, one for each counter."""
    least, counts = {}, defaultdict(int)
    for b in batches:
        for key, doc_id, part, mask, good, toxic, n in zip(*(c.to_pylist() for c in b.columns)):
            if doc_id is None:
                counts[part, mask, good, toxic] += n
                continue
            held = least.get(key)
            if held is None or doc_id < held[0]:
                least[key] = doc_id, mask, {(part, good, toxic): n}
                loser = held
            elif doc_id == held[0]:
                held[2][part, good, toxic] = held[2].get((part, good, toxic), 0) + n
                loser = None
            else:
                loser = doc_id, mask, {(part, good, toxic): n}
            if loser:
                for flags, some in loser[2].items():
                    counts[flags[0], mask | E_BIT, *flags[1:]] += some
    rows = []
    for key, (doc_id, mask, held) in least.items():
        for (part, good, toxic), n in held.items():
            rows.append((key, doc_id, part, mask, good, toxic, n))
            counts[part, mask, good, toxic] += n
    for (part, mask, good, toxic), n in counts.items():
        name = f"{part}|{mask}|{good}|{toxic}".encode()
        rows.append((b"count:" + hashlib.md5(name).digest(), 0, part, mask, good, toxic, n))
    yield from _batches(rows, _LIGHT)


_FLAGS = ["part", "mask", "good", "toxic"]


def _retract(n_lots: int):
    """The state function: changes of the counters that a batch's rows of one lot bring about. The
    state is the rows of the smallest id of every text of the lot, as an Arrow file."""
    schema = _LIGHT

    def retract(lot, pdfs, state):
        rows = pd.concat(list(pdfs), ignore_index=True)
        if lot[0] >= n_lots:  # counters, for all texts of a task
            yield rows.groupby(_FLAGS, as_index=False)["n"].sum()
            return
        if state.exists:
            held = pa.ipc.open_stream(state.get[0]).read_pandas()
            rows = pd.concat([held, rows[held.columns]], ignore_index=True)
        least = rows.groupby("key")["doc_id"].transform("min")
        late = rows[rows["doc_id"] > least]
        held = rows[rows["doc_id"] == least].groupby(["key", "doc_id", *_FLAGS], as_index=False)["n"].sum()
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, schema) as writer:
            writer.write_table(pa.Table.from_pandas(held[schema.names], schema, preserve_index=False))
        state.update((out.getvalue().to_pybytes(),))
        if len(late):
            back = late.assign(n=-late["n"])
            anew = late.assign(mask=late["mask"] | E_BIT)
            yield pd.concat([back, anew]).groupby(_FLAGS, as_index=False)["n"].sum()
    return retract


@contextmanager
def _settings(spark: SparkSession, wanted: dict):
    """Session settings for the length of a block."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _pattern(path: str) -> str:
    """A pattern that matches ``path`` alone: a stream reads folders, or files by a pattern."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def mask_counts(spark: SparkSession, path: str, labels: DataFrame, n_batches: int = BATCHES
                ) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters that they fail, and how many
    of them are labelled good and toxic. ``path`` is a Parquet table of documents."""
    scratch = Scratch(spark, "filter-audit")
    table = spark.read.parquet(path)
    files = max(1, -(-len(table.inputFiles()) // n_batches))
    n_lots = max(1, table.count() // LOT_TEXTS)
    known = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")) \
        .withColumn("lot", F.lit(0))
    known = scratch.write(known, "labels")

    def count(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")) \
            .write.mode("overwrite").parquet(scratch.path(f"log/batch={batch_id}"))

    bounded_batches(spark)
    with _settings(spark, _CONF):
        # files of any age are read; by default those a week older than the newest are not
        rows = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files) \
            .option("maxFileAge", "36500d").parquet(_pattern(path)) \
            .select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce("source", F.lit("")).alias("part"), "text") \
            .mapInArrow(_judge, _ROWS)
        # rows without an id have no label; they are dealt to lots that no label is in
        lot = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64("key"), F.lit(1 << 20))) \
            .otherwise(0)
        rows = rows.withColumn("lot", lot)
        labelled = rows.join(known, (rows["doc_id"] == known["id"]) & (rows["lot"] == known["lot"]),
                             "left").select("key", "doc_id", "part", "mask", *[
                                 F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")], "n")
        is_text = F.octet_length("key") == hashlib.sha256().digest_size
        lot = F.when(is_text, F.pmod(F.xxhash64("key"), F.lit(n_lots))) \
            .otherwise(n_lots + F.pmod(F.xxhash64("key"), F.lit(n_lots)))
        changes = labelled.mapInArrow(_combine, _LIGHT_DDL).withColumn("lot", lot).groupBy("lot") \
            .applyInPandasWithState(_retract(n_lots), _CHANGES, "rows binary", "update", "NoTimeout")
        changes.writeStream.outputMode("update").foreachBatch(count) \
            .option("checkpointLocation", scratch.path("checkpoint")) \
            .trigger(availableNow=True).start().awaitTermination()
    spark.createDataFrame([], f"{_CHANGES}").write.parquet(scratch.path("log/batch=-1"))
    log = spark.read.schema(_CHANGES).parquet(scratch.path("log"))
    return log.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """Every part, order of the filters and step, from the counts of the masks. A step removes the
    masks that fail its filter and none before it. Of all orders, the filter comes first among the
    k that a mask fails in one of k."""
    n_orders = len(list(itertools.permutations(FILTERS)))
    steps = F.explode(F.array(*[
        F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(k + 1).alias("step"),
                 F.lit(1 << FILTERS.index(order[k])).alias("bit"),
                 F.lit(sum(1 << FILTERS.index(x) for x in order[:k])).alias("earlier"))
        for order in itertools.permutations(FILTERS) for k in range(len(order))]))
    rows = counts.withColumn("at", steps).select("*", "at.*").drop("at")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("earlier")) != 0
    first = fails & ~gone

    def total(where, what="n"):
        return F.sum(F.when(where, F.col(what)).otherwise(0)).cast("long")
    share = F.col("n") * n_orders / F.bit_count(F.col("mask"))
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(first).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(first, "good").alias("good_lost"), total(first, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.round(share).cast("long")).otherwise(0)).cast("long")
        .alias("shapley"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = mask_counts(spark, f"{sf_dir}/documents.parquet", documents(spark, sf_dir, "labels"))
    return audit(counts)


#: Each document's mask, then every order and step over the documents of each mask.
OP11_SQL = """
WITH marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), judged AS (
  SELECT doc_id, part, [
    len(words) < 200,
    100 * len(list_distinct(words)) < 50 * len(words),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
    regexp_matches(text, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM texts
), rows AS (
  SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM judged LEFT JOIN marks USING (doc_id)
), letters AS (
  SELECT unnest(range(1, 6)) AS f
), orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT list_aggregate(list_transform(o, lambda x: substr('ABCDE', x::INT, 1)), 'string_agg', '')
    AS filter_order, k::INT AS step, o[k] AS f, o[:k - 1] AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS k)
), masks AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic,
    len(list_filter(fails, lambda x: x)) AS size
  FROM rows GROUP BY part, fails
), seen AS (
  SELECT m.*, s.*, fails[f] AS failed, len(list_filter(earlier, lambda x: fails[x])) > 0 AS gone
  FROM masks m, steps s
), report AS (
  SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT failed AND NOT gone), 0) AS kept,
    coalesce(sum(n) FILTER (failed AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (failed AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (failed AND size = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (failed AND NOT gone), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (failed AND NOT gone), 0) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley
FROM report
"""
