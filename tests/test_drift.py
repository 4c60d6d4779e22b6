"""Schema drift read from the footers of landed files."""

from pyspark.sql import types as T

from ledgerlake.operators.drift import schema_drift_files

DECLARED = T.StructType([T.StructField("id", T.StringType()), T.StructField("amount", T.DoubleType()),
                         T.StructField("flag", T.BooleanType())])


def _land(spark, base, day, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append") \
        .parquet(f"{base}/year=2024/month=01/day={day}")


def _rows(df):
    return {(r.run_date, r.column_name, r.issue, r.landed_type): (r.n_files, r.n_rows, r.bad_values)
            for r in df.collect()}


def test_files_of_one_day_differ(spark, scratch):
    base = f"{scratch}/lake with space/raw/txn"
    _land(spark, base, "01", [("a", 1.0, True), ("b", None, None)], "id string, amount double, flag boolean")
    _land(spark, base, "01", [("c", "7.5", "x"), ("d", "n/a", "y"), ("e", "n/a", None), ("f", None, None)],
          "id string, amount string, promo string")
    _land(spark, base, "02", [(1, 2, "true"), (2, 3, "maybe")], "id long, amount int, flag string")
    got = _rows(schema_drift_files(spark, base, DECLARED))
    one, two = "2024-01-01", "2024-01-02"
    assert got == {
        (one, "id", "ok", "string"): (2, 6, 0),
        (one, "amount", "ok", "double"): (1, 2, 0),
        (one, "amount", "type_changed", "string"): (1, 4, 2),
        (one, "flag", "ok", "boolean"): (1, 2, 0),
        (one, "flag", "missing", None): (1, 4, 0),
        (one, "promo", "extra", "string"): (1, 4, 0),
        (two, "id", "type_changed", "bigint"): (1, 2, 0),
        (two, "amount", "type_changed", "int"): (1, 2, 0),
        (two, "flag", "type_changed", "string"): (1, 2, 1),
    }


def test_files_outside_date_folders_and_without_rows(spark, scratch):
    spark.createDataFrame([], "id string, amount array<double>").coalesce(1).write.parquet(f"{scratch}/x")
    got = _rows(schema_drift_files(spark, f"{scratch}/x", DECLARED))
    assert got == {
        (None, "id", "ok", "string"): (1, 0, 0),
        (None, "amount", "type_changed", "array<double>"): (1, 0, 0),
        (None, "flag", "missing", None): (1, 0, 0),
    }


def test_no_content_of_the_files_is_read(spark, scratch):
    _land(spark, scratch, "01", [("a", 1.0, True)], "id string, amount double, flag boolean")
    plan = schema_drift_files(spark, scratch, DECLARED)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan
