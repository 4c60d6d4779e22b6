"""Physical-plan properties the design relies on."""

import re

from tests.conftest import SF_SMOKE
from ledgerlake.params import Params
from tests.test_skew import no_broadcast

import __spark_entry__ as E
from ledgerlake.schemas import RAW_TRANSACTIONS
from ledgerlake.sources.lake import read_zone, upload_dataframe
from tests.helpers import raw_txn_df, txn


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    plan = _plan(E.queries()["stg_fraud_signals"](spark, SF_SMOKE))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert scans and all(set(s.replace("#", " ").split(",")) for s in scans)
    # the signal feed only needs the id and the time of each event
    assert all("user_id" not in s and "value" not in s for s in scans)
    assert "PushedFilters: [IsNotNull(event_id)]" in plan


def test_no_python_udfs_and_whole_stage_codegen(spark):
    for name in ["txn_enriched", "mart_transaction_summary", "validate_rule_counts",
                 "velocity_rolling_1h", "mart_compliance"]:
        df = E.queries()[name](spark, SF_SMOKE)
        df.collect()
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "*(" in plan, name      # whole-stage codegen spans present


def test_only_bounded_sides_are_broadcast_at_scale(spark):
    """With size-based broadcasting off (as for large inputs), the only broadcasts left are
    the lists of keys with more than ``hot_key_rows`` rows."""
    with no_broadcast(spark):
        plan = _plan(E.queries()["txn_enriched"](spark, SF_SMOKE))
        assert plan.count("BroadcastExchange") >= 1
        for m in re.finditer(r"BroadcastExchange.*\n((?:.*\n){0,12})", plan):
            assert str(Params().hot_key_rows) in m.group(1)


def test_partition_pruning_on_lake_reads(spark, scratch):
    df = raw_txn_df(spark, [txn("a")])
    for d in ["2025-05-06", "2025-05-07", "2025-06-01"]:
        upload_dataframe(df, scratch, "transactions", "raw", d)
    one = read_zone(spark, scratch, "transactions", RAW_TRANSACTIONS, partition_date="2025-05-07")
    one.collect()
    plan = _plan(one)
    pf = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert pf and "year" in pf.group(1) and "month" in pf.group(1)
    assert one.count() == 1


def test_hot_date_written_by_several_tasks(spark, scratch):
    from pyspark.sql import functions as F
    from ledgerlake.operators.evolve import layout_for_write
    df = spark.range(3000).select(
        F.lit("2025-01-01").cast("date").alias("transaction_date"),
        (F.col("id") % 5).cast("string").alias("region"),
        F.concat(F.lit("A"), F.col("id").cast("string")).alias("account_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("pad"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        layout_for_write(df).write.partitionBy("transaction_date").parquet(f"{scratch}/t")
    finally:
        spark.conf.set(key, old)
    import os
    files = [f for f in os.listdir(f"{scratch}/t/transaction_date=2025-01-01")
             if f.endswith(".parquet")]
    assert len(files) > 1
