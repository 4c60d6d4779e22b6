"""Hot keys are split across tasks, and splitting never changes results."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from ledgerlake.operators.joins import lookup_join
from ledgerlake.operators.validate import flag_rows
from ledgerlake.operators.velocity import VELOCITY_KEYS, hourly_velocity
from ledgerlake.params import Params
from ledgerlake.plans.compare import comparable
from ledgerlake.plans.enriched import transactions_enriched
from ledgerlake.plans.staging import stg_fraud_signals, stg_transactions
from tests.helpers import raw_sig_df, raw_txn_df, sig, txn


@contextmanager
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.coalescePartitions.enabled"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1" if "Threshold" in k else "false")
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot_rows():
    rows = [txn(f"h{i}", account_id="HOT", amount=float(i % 50),
                timestamp=f"2025-05-16T10:{i % 60:02d}:{i % 59:02d}") for i in range(400)]
    rows += [txn(f"c{i}", account_id=f"A{i % 7}", timestamp="2025-05-16T11:00:00")
             for i in range(60)]
    return rows


def _sorted(df):
    return sorted(tuple(str(v) for v in r) for r in comparable(df).collect())


def test_salted_velocity_join_spreads_hot_key_and_keeps_results(spark):
    with no_broadcast(spark):
        t = stg_transactions(raw_txn_df(spark, _hot_rows()).repartition(8))
        v = hourly_velocity(t).select(*VELOCITY_KEYS, "txn_count_1h", "total_amount_1h")
        salted = lookup_join(t, v, VELOCITY_KEYS, count_col="txn_count_1h", hot_rows=50,
                             salt_cols=["transaction_id"])
        plain = lookup_join(t, v, VELOCITY_KEYS)
        assert _sorted(salted) == _sorted(plain)
        # keep a lookup column in the projection, or the optimizer drops the left join
        parts = (salted.filter(F.col("account_id") == "HOT")
                 .select(F.spark_partition_id().alias("p"), "txn_count_1h").distinct().count())
        unsalted = (plain.filter(F.col("account_id") == "HOT")
                    .select(F.spark_partition_id().alias("p"), "txn_count_1h").distinct().count())
        assert unsalted == 1 and parts >= 4
        assert "SortMergeJoin" in salted._jdf.queryExecution().executedPlan().toString()


def test_enriched_same_with_and_without_salting(spark):
    sigs = [sig(f"h{i}", 0.8) for i in range(0, 400, 37)]
    with no_broadcast(spark):
        t = stg_transactions(raw_txn_df(spark, _hot_rows()))
        f = stg_fraud_signals(raw_sig_df(spark, sigs))
        a = transactions_enriched(t, f, Params(hot_key_rows=50))
        b = transactions_enriched(t, f, Params(hot_key_rows=None))
        assert _sorted(a) == _sorted(b)


def test_duplicate_copies_split_and_flagged(spark):
    copies = [txn("same")] * 300 + [txn(None)] * 120 + [txn(f"u{i}") for i in range(40)]
    with no_broadcast(spark):
        df = raw_txn_df(spark, copies).repartition(8)
        salted = flag_rows(df, Params(hot_key_rows=50))
        plain = flag_rows(df, Params(hot_key_rows=None))
        got = {(r["transaction_id"], r["duplicate_transaction_id"], r["n"])
               for r in salted.groupBy("transaction_id", "duplicate_transaction_id")
               .agg(F.count(F.lit(1)).alias("n")).collect()}
        assert ("same", True, 300) in got and (None, True, 120) in got
        assert ("u0", False, 1) in got
        assert _sorted(salted) == _sorted(plain)
        parts = (salted.filter(F.col("transaction_id") == "same")
                 .select(F.spark_partition_id().alias("p"), "duplicate_transaction_id")
                 .distinct().count())
        assert parts >= 4


def test_fanout_join_splits_hot_right_key(spark):
    from ledgerlake.operators.joins import fanout_join
    left = spark.createDataFrame([("hot", 1), ("hot", 2), ("cold", 3), ("none", 4), (None, 5)],
                                 "k string, lv int")
    right = spark.createDataFrame([("hot", i) for i in range(600)] + [("cold", 1), ("cold", 2)]
                                  + [("orphan", 9)], "k string, rv int").repartition(8)
    with no_broadcast(spark):
        salted = fanout_join(left, right, "k", hot_rows=50)
        plain = left.join(right, "k", "left")
        assert _sorted(salted) == _sorted(plain)
        assert salted.count() == 1200 + 2 + 1 + 1
        parts = (salted.filter(F.col("k") == "hot")
                 .select(F.spark_partition_id().alias("p"), "rv").select("p").distinct().count())
        assert parts >= 4


def test_enriched_with_hot_scored_transaction(spark):
    rows = [txn("hot", account_id="H"), txn("c1"), txn("c2", account_id="Z")]
    sigs = [sig("hot", round(0.001 * i, 4)) for i in range(500)] + [sig("c1", 0.9)]
    with no_broadcast(spark):
        t = stg_transactions(raw_txn_df(spark, rows))
        f = stg_fraud_signals(raw_sig_df(spark, sigs).repartition(8))
        a = transactions_enriched(t, f, Params(hot_key_rows=20))
        b = transactions_enriched(t, f, Params(hot_key_rows=None))
        assert _sorted(a) == _sorted(b) and a.count() == 502
