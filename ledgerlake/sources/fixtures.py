"""Deterministic raw inputs derived from the shared ``events`` table.

The reference only ships unseeded random generators, so the raw transaction and fraud-signal
feeds are derived here from ``events`` by fixed modulo rules (documented in FIXTURES.md).
Every rule is a column expression, so the mapping is one narrow projection per event (with
a generator for the duplicated and re-scored subsets); it grows linearly with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.constants import FRAUD_MODEL_VERSION
from ledgerlake.functions.risk import fraud_reasons

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value"]


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Read one shared test table.

    A table stored as one Parquet row group scans as one task, and with broadcast joins the
    whole pipeline up to the first shuffle would then run in that task. When the scan has
    fewer splits than the cluster has cores, rows are spread round-robin first (deterministic,
    so a retried task sees the same rows). Inputs made of many files already have enough
    splits and are left alone.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:  # plans the scan; runs no job
            # Round-robin references no column, so column pruning still reaches the scan
            # (a hash on the row's columns would force every column to be read); Spark sorts
            # before a round-robin shuffle, so a retried task produces the same split.
            df = df.repartition(cores)
    return df


def _k() -> Column:
    return F.col("event_id")


def _mod(n: int) -> Column:
    return F.pmod(_k(), F.lit(n))


def _folded_ts() -> Column:
    """30 days folded into 3 (Jan 1-3 2024), whole seconds."""
    ts = F.col("ts")
    return F.make_timestamp(
        F.lit(2024), F.lit(1), F.pmod(F.dayofmonth(ts) - 1, F.lit(3)) + 1,
        F.hour(ts), F.minute(ts), F.second(ts))


def raw_transactions_from_events(events: DataFrame) -> DataFrame:
    """Every event once, plus a second copy of events with ``k % 211 = 0``."""
    e = events.select(*EVENT_COLS)
    ts = _folded_ts()
    mapped = e.select(
        _k().cast("string").alias("transaction_id"),
        F.when(_mod(151) == 0, F.lit(None).cast("string"))
         .when(_mod(5) == 0, F.lit("ACC_HOT"))
         .otherwise(F.concat(F.lit("ACC_"), F.col("user_id").cast("string"))).alias("account_id"),
        F.when(_mod(97) == 0, -F.col("value"))
         .when(_mod(113) == 0, F.lit(0.0))
         .when(_mod(499) == 0, F.col("value") * 100000)
         .when(_mod(50) == 1, F.col("value") * 1000)
         .otherwise(F.col("value") * 40).alias("amount"),
        F.when(_mod(89) == 0, F.lit("BRL"))
         .when(_mod(10) == 3, F.lit(" eur "))
         .when(_mod(10) == 4, F.lit("GBP"))
         .otherwise(F.lit("USD")).alias("currency"),
        F.when(_mod(131) == 0, F.lit("chargeback"))
         .when(_mod(137) == 0, F.lit(None).cast("string"))
         .when(_mod(40) == 7, F.lit(" Debit "))
         .when(F.col("event_type") == "click", F.lit("debit"))
         .when(F.col("event_type") == "view", F.lit("credit"))
         .when(F.col("event_type") == "purchase", F.lit("transfer"))
         .when(F.col("event_type") == "signup", F.lit("withdrawal"))
         .otherwise(F.lit("deposit")).alias("transaction_type"),
        F.when(_mod(23) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("MERCH_"), _mod(199).cast("string"))).alias("merchant_id"),
        ts.cast("string").alias("timestamp"),
        F.when(_mod(100) < 90, F.lit("completed"))
         .when(_mod(100) < 97, F.lit("Pending"))
         .otherwise(F.lit("failed")).alias("status"),
        F.element_at(F.array(*[F.lit(r) for r in ["us-east", "US-WEST", "EU", "APAC", "LATAM"]]),
                     (_mod(5) + 1).cast("int")).alias("region"),
        F.when(_mod(7) == 0, F.lit("mobile")).when(_mod(7) == 1, F.lit("web"))
         .when(_mod(7) == 2, F.lit("ATM")).when(_mod(7) == 3, F.lit("branch"))
         .otherwise(F.lit("api")).alias("channel"),
        F.lit("10.0.0.1").alias("ip_address"),
        F.lit("DEV_10000").alias("device_id"),
        (ts + F.expr("INTERVAL 15 MINUTES")).cast("string").alias("ingested_at"),
        # one copy per event, two for k % 211 = 0: a generator, not a second scan + union
        F.explode(F.when(_mod(211) == 0, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return mapped.drop("_copy")


def raw_fraud_signals_from_events(events: DataFrame) -> DataFrame:
    """Events with ``k % 3 <> 0`` scored by rule, plus a second score 0.8 for ``k % 307 = 0``."""
    e = events.select("event_id", "ts")
    bucket = F.pmod(_k() * 7919, F.lit(10000))
    rule = F.struct((bucket.cast("double") / 10000).alias("s"), (bucket >= 7500).alias("f"))
    second = F.struct(F.lit(0.8).alias("s"), F.lit(True).alias("f"))
    # 0, 1 or 2 scores per event from one scan: the rule score when k % 3 <> 0, and a
    # second score of 0.8 when k % 307 = 0.
    scores = F.array_compact(F.array(F.when(_mod(3) != 0, rule), F.when(_mod(307) == 0, second)))
    exploded = e.select(_k(), "ts", F.explode(scores).alias("sc"))
    return exploded.select(
        _k().cast("string").alias("transaction_id"),
        F.col("sc.s").alias("fraud_score"),
        F.col("sc.f").alias("is_flagged"),
        fraud_reasons(F.col("sc.s")).alias("fraud_reasons"),
        F.lit(FRAUD_MODEL_VERSION).alias("model_version"),
        (_folded_ts() + F.expr("INTERVAL 15 MINUTES")).cast("string").alias("scored_at"),
    )


def text_signals_from_events(events: DataFrame) -> DataFrame:
    """The same scores as a feed of text, with ids, scores, flags and times that are missing or do
    not convert (by modulo rules, one in some fifty to eighty each)."""
    scored = raw_fraud_signals_from_events(events).withColumn(
        "k", F.col("transaction_id").cast("bigint"))

    def mod(n: int) -> Column:
        return F.col("k") % n == 0
    digits = F.lpad(F.round(F.col("fraud_score") * 10000).cast("bigint").cast("string"), 4, "0")
    null = F.lit(None).cast("string")
    return scored.select(
        F.when(~mod(79), F.col("transaction_id")).alias("transaction_id"),
        F.when(mod(53), F.lit("n/a")).when(mod(59), F.lit("123.0")).when(mod(61), null)
         .when(mod(67), F.lit("NaN")).otherwise(F.concat(F.lit("0."), digits)).alias("fraud_score"),
        F.when(mod(83), F.lit("maybe")).otherwise(F.col("is_flagged").cast("string"))
         .alias("is_flagged"),
        F.when(mod(71), F.lit("yesterday")).when(mod(73), null).otherwise(F.col("scored_at"))
         .alias("scored_at"),
        "model_version")


def fx_rates_from_nation(nation: DataFrame) -> DataFrame:
    """One rate per nation: currencies in turn, a day each from 2023-12-25 on, so that a currency
    has a rate on every third day."""
    k = F.col("n_nationkey")
    codes = F.array(*[F.lit(c) for c in ("EUR", "GBP", "BRL")])
    return nation.select(
        F.element_at(codes, (F.pmod(k, F.lit(3)) + 1).cast("int")).alias("currency_code"),
        F.date_add(F.lit("2023-12-25").cast("date"), k.cast("int")).alias("rate_date"),
        ((100 + k).cast("decimal(18,8)") / 100).cast("decimal(18,8)").alias("usd_per_unit"))


def accounts_from_customer(customer: DataFrame) -> DataFrame:
    """Two versions of every customer's account; customer 0 holds the busy account."""
    k = F.col("c_custkey").cast("string")
    return customer.select(
        F.when(F.col("c_custkey") == 0, F.lit("ACC_HOT")).otherwise(F.concat(F.lit("ACC_"), k))
         .alias("account_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("version"),
        "c_mktsegment", "c_nationkey").select(
        "account_id", "version",
        F.when(F.col("version") == 2, F.col("c_mktsegment")).otherwise(F.lit("NEW")).alias("segment"),
        F.col("c_nationkey").cast("int").alias("nation"))


def raw_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = read_table(spark, sf_dir, "events")
    return raw_transactions_from_events(events), raw_fraud_signals_from_events(events)
