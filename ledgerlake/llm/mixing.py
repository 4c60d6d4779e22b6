"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

1. Targets. Sources ordered by code point (null last) get the weights in turn; they share the
   budget by weight, no source above ``max_repeats`` times its size. The water level
   ``level = (budget - capped) / open weights`` is exact: sources are capped in ascending order
   of cap / weight.
2. Shards. The documents of a source are dealt by a seeded hash to shards of bounded size, so a
   hot source is many small groups.
3. Quotas. The target words are given to sources, turned into blocks of the source's own size
   (single words where source or target is small), and these given to its shards, by highest
   quotients votes / (2 k + 1). Only the quotients near the cut are made as rows: at
   divisor V / (B - n/2) every seat is certain, at V / (B + n/2) all seats are covered, so at
   most two candidates a party are ranked.
4. Selection. In a shard the documents lie in seeded order and are cut into blocks of equal
   size; a quota of q among n blocks takes every block ``q div n`` times and a run of
   ``q mod n`` blocks, from a seeded offset, once more.

Defined cases: null and empty texts have size 0 and are never taken; a null source is a source
of its own; rows with the same doc_id and text are separate rows; no documents or only empty
ones give targets 0; extra columns are kept or ignored, never read. Only DataFrame operations.
The table of sources (one row each) is the one thing ordered in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import Scratch, columns, documents

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK_TOKENS = 16
#: A source of fewer blocks than this, or with a target of fewer, has blocks of one word.
SMALL_BLOCKS = 16
SHARD_TOKENS = 1 << 22
SHARD_ROWS = 50_000
SEED = 17
_WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, rows, target) of a table of (source, size)."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                    F.count("*").alias("rows"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    s = s.withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int")).cast("double"))
    s = s.withColumn("cap", max_repeats * F.col("source_size").cast("double"))
    whole = W.partitionBy()
    before = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()) \
        .rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("total", F.sum(F.col("source_size").cast("double")).over(whole)) \
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                    / (F.sum("weight").over(whole)
                       - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the level of the first source that it doesn't cap holds for all sources after it
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"),
                         F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))) \
        .over(whole)["level"]
    return s.withColumn("target", F.least("cap", F.coalesce(level * F.col("weight"), "cap"))) \
        .select("source", "source_size", "rows", "target")


def sainte_lague(parties: DataFrame, key: list[str], tie: list[str], votes: str,
                 seats: Column) -> DataFrame:
    """``parties`` with the column ``quota``: seats of each party within its group ``key``."""
    g = W.partitionBy(*key)
    p = parties.withColumn("_v", F.sum(votes).over(g)).withColumn("_n", F.count("*").over(g)) \
        .withColumn("_b", seats.cast("long"))
    at = lambda b: F.when(F.col("_v") > 0, F.floor(F.col(votes) * F.greatest(
        b, F.lit(0.0)) / F.col("_v") + 0.5)).otherwise(F.lit(0)).cast("long")
    p = p.withColumn("_sure", at(F.col("_b") - F.col("_n") / 2)) \
        .withColumn("_most", at(F.col("_b") + F.col("_n") / 2)) \
        .withColumn("_open", F.col("_b") - F.sum("_sure").over(g))
    seat = p.filter(F.col("_most") > F.col("_sure")) \
        .withColumn("_k", F.explode(F.sequence("_sure", F.col("_most") - 1)))
    ranked = seat.withColumn("_r", F.row_number().over(
        g.orderBy((F.col(votes) / (2 * F.col("_k") + 1)).desc(), *tie)))
    won = ranked.filter(F.col("_r") <= F.col("_open")) \
        .groupBy(*key, *tie).agg(F.count("*").alias("_won"))
    p, won = p.alias("p"), won.alias("w")
    same = F.lit(True)
    for c in [*key, *tie]:
        same = same & F.col(f"p.{c}").eqNullSafe(F.col(f"w.{c}"))
    return p.join(won, same, "left").select(
        *[F.col(f"p.{c}") for c in parties.columns],
        (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias("quota"))


def mix(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS,
        block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """``sizes`` (a stored table of doc_id, text_id, source, size) with source_size, target and the
    selection: ``whole`` copies, then the words [a, b) and [c, d) once more; ``taken`` words."""
    scratch = Scratch(sizes.sparkSession, "mix")
    sources = scratch.write(source_targets(sizes, weights, max_repeats), "sources")
    shards_of = F.ceil(F.greatest(F.col("source_size") / SHARD_TOKENS,
                                  F.col("rows") / SHARD_ROWS, F.lit(1.0)))
    d, s = sizes.alias("d"), sources.alias("s")
    dealt = d.join(s, F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.doc_id", "d.text_id", "d.source", "size", "source_size", "target", "rows",
        F.xxhash64(F.lit(seed), "d.doc_id").alias("_order"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "d.doc_id"), shards_of).alias("shard"))
    shards = dealt.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"))
    small = F.least(F.col("source_size"), F.col("target")) < SMALL_BLOCKS * block_tokens
    blocks = F.when(small, F.col("shard_size")).otherwise(
        F.greatest(F.round(F.col("shard_size") / block_tokens), F.lit(1.0))).cast("long")
    by_source = shards.withColumn("blocks", F.when(F.col("shard_size") > 0, blocks)
                                  .otherwise(F.lit(0).cast("long")))
    source_quota = sainte_lague(
        sources.withColumn("_all", F.lit(0)), ["_all"], ["source"], "target",
        F.round(F.sum("target").over(W.partitionBy("_all")))) \
        .select(F.col("source").alias("_s"), F.col("quota").alias("_words"))
    by_source = by_source.join(source_quota, F.col("source").eqNullSafe(F.col("_s"))).drop("_s") \
        .withColumn("_votes", F.col("blocks").cast("double")) \
        .withColumn("source_quota", F.when(F.col("source_size") > 0, F.round(
            F.col("_words") * F.sum("_votes").over(W.partitionBy("source"))
            / F.col("source_size"))).otherwise(F.lit(0.0)))
    quotas = scratch.write(sainte_lague(
        by_source, ["source"], ["shard"], "_votes", F.col("source_quota"))
        .select("source", "shard", "shard_size", "blocks",
                F.least(F.col("quota"), max_repeats * F.col("blocks")).alias("quota")), "quotas")
    d, q = dealt.alias("d"), quotas.alias("q")
    placed = d.join(q, F.col("d.source").eqNullSafe(F.col("q.source"))
                    & (F.col("d.shard") == F.col("q.shard"))) \
        .select("d.*", "shard_size", "blocks", "quota")
    order = W.partitionBy("source", "shard").orderBy("_order", "doc_id", "text_id")
    end = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))
    n = F.greatest(F.col("blocks"), F.lit(1))
    edge = lambda b: F.expr("shard_size * ({}) div greatest(blocks, 1)".format(b))
    placed = placed.withColumn("_to", end).withColumn("_from", F.col("_to") - F.col("size")) \
        .withColumn("whole", F.expr("quota div greatest(blocks, 1)")) \
        .withColumn("_more", F.pmod(F.col("quota"), n)) \
        .withColumn("_first", F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), n))
    runs = placed.withColumn("_a0", edge("_first")) \
        .withColumn("_a1", edge("least(_first + _more, blocks)")) \
        .withColumn("_b1", edge("greatest(_first + _more - blocks, 0)"))
    cut = lambda x: F.least(F.greatest(x - F.col("_from"), F.lit(0)), F.col("size"))
    runs = runs.withColumn("a", cut(F.col("_a0"))).withColumn("b", cut(F.col("_a1"))) \
        .withColumn("c", F.lit(0).cast("long")).withColumn("d", cut(F.col("_b1")))
    taken = F.col("size") * F.col("whole") + F.col("b") - F.col("a") + F.col("d") - F.col("c")
    return runs.select("doc_id", "text_id", "source", "size", "source_size", "target", "whole",
                       "a", "b", "c", "d", taken.alias("taken"))


def stored_sizes(docs: DataFrame) -> DataFrame:
    sizes = columns(docs, "doc_id", "source", "text") \
        .select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_id"), "source",
                size_of(F.col("text")).alias("size"))
    return Scratch(docs.sparkSession, "sizes").write(sizes, "sizes")


def materialise(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken. The runs at the edges of
    a selection give rows of the words taken; rows that repeat doc_id and text count once."""
    chosen = mixed.filter("taken > 0").dropDuplicates(["doc_id", "text_id"]).select(
        *[F.col(c).alias(f"_{c}") for c in ("doc_id", "text_id", "size", "whole", *"abcd")])
    words = F.regexp_extract_all(F.col("text"), F.lit(_WORD), F.lit(0))
    length = lambda x, y: F.col(y) - F.col(x)
    full = lambda x, y: length(x, y) == F.col("_size")
    cut = lambda x, y: F.when((length(x, y) > 0) & ~full(x, y), F.array(
        F.concat_ws(" ", F.slice(words, F.col(x).cast("int") + 1, length(x, y).cast("int"))))) \
        .otherwise(F.array().cast("array<string>"))
    copies = F.col("_whole") + full("_a", "_b").cast("long") + full("_c", "_d").cast("long")
    texts = F.concat(F.array_repeat("text", copies.cast("int")), cut("_a", "_b"),
                     cut("_c", "_d"))
    rows = docs.join(chosen, docs["doc_id"].eqNullSafe(F.col("_doc_id"))
                     & (F.md5(F.coalesce(docs["text"], F.lit(""))) == F.col("_text_id")))
    rows = rows.withColumn("_one", F.explode(texts)).withColumn("text", F.col("_one"))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(stored_sizes(documents(spark, sf_dir))) \
        .select("doc_id", "size", "source_size", "target", "taken")
