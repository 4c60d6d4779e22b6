"""Dense numbers and the warehouse loads that use them."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.numbering import number_rows
from ledgerlake.plans.commit import BatchRun
from ledgerlake.plans.staging import stg_fraud_signals
from ledgerlake.plans.warehouse import fraud_signals_path, load_fraud_signals
from tests.helpers import raw_sig_df, sig


def test_numbers_are_dense_and_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), F.lit("x").alias("w")) \
        .repartition(6)
    got = number_rows(df, ["v"], "n", 11).orderBy("v").collect()
    assert [r["n"] for r in got] == list(range(11, 5011))
    assert number_rows(df.filter("v < 0"), ["v"], "n").count() == 0
    one = number_rows(df.withColumn("v", F.lit(1)), ["v"], "n")  # all rows alike
    assert sorted(r["n"] for r in one.collect()) == list(range(1, 5001))


def test_ids_go_on_over_runs(spark, scratch, monkeypatch):
    def load(key, ids):
        run = BatchRun(spark, scratch, key)
        if run.done is None:
            load_fraud_signals(run, stg_fraud_signals(raw_sig_df(spark, [sig(i) for i in ids])))
            run.commit()

    load("a", ["x", "y", "y"])
    with monkeypatch.context() as m:
        m.setattr(BatchRun, "commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load("b", ["lost"])
    load("a", ["x", "y", "y"])  # done before
    load("b", ["p", "o"])
    load("c", [])
    load("d", ["z"])
    rows = spark.read.parquet(fraud_signals_path(scratch)).select("id", "transaction_id").collect()
    assert sorted(map(tuple, rows)) == [(1, "x"), (2, "y"), (3, "y"), (4, "o"), (5, "p"), (6, "z")]
