"""Schema drift of landed Parquet files, file by file.

A reader that is given a schema does not notice a file without a column (it reads NULLs) or with
one column more, and fails on one whose type has changed. Here every file's own schema is compared
with the declared one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_FOUND = ("path string, column_name string, issue string, expected_type string, "
          "landed_type string, n_rows bigint, value string, n_values bigint")


def file_columns(spark: SparkSession, base: str, expected: T.StructType) -> DataFrame:
    """One row per file below ``base`` and column, declared or landed, with its ``issue``:
    ``missing``, ``extra``, ``type_changed`` or ``ok``, and the rows of the file; for columns whose
    type has changed also one row per distinct value of a row group, as text, with its count.

    Spark lists the files (no content is read) and deals them by size; tasks read the footers,
    and of the data only the columns with another type, a row group at a time. The files must be
    in a store that Arrow opens too (local or shared folders, HDFS, S3, GCS, ABFS)."""
    declared = {f.name: f.dataType.simpleString() for f in expected.fields}
    columns = _FOUND.split(", ")

    def footers(batches):
        from urllib.parse import quote

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        from pyspark.errors import PySparkTypeError
        from pyspark.sql.pandas.types import from_arrow_type

        def spark_name(dtype):
            try:
                return from_arrow_type(dtype).simpleString()
            except PySparkTypeError:
                return str(dtype)

        names = [c.split()[0] for c in columns]
        types = [pa.int64() if c.endswith("bigint") else pa.string() for c in columns]

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*rows), types)], names)

        for b in batches:
            for path in b.column(0).to_pylist():
                fs, at = pafs.FileSystem.from_uri(quote(path, safe=":/=%"))
                with fs.open_input_file(at) as source:
                    file = pq.ParquetFile(source)
                    n = file.metadata.num_rows
                    landed = {f.name: spark_name(f.type) for f in file.schema_arrow}
                    rows, changed = [], []
                    for name in [*declared, *[c for c in landed if c not in declared]]:
                        want, has = declared.get(name), landed.get(name)
                        issue = "missing" if has is None else "extra" if want is None else \
                            "ok" if want == has else "type_changed"
                        rows.append((path, name, issue, want, has, n, None, None))
                        if issue == "type_changed":
                            changed.append(rows[-1])
                    yield batch(rows)
                    for row in changed:
                        for g in range(file.num_row_groups):
                            column = file.read_row_group(g, columns=[row[1]]).column(0)
                            try:
                                column = pc.cast(column, pa.string())
                            except pa.ArrowNotImplementedError:  # nested: no text, no value converts
                                column = pa.array([None if v is None else str(v)
                                                   for v in column.to_pylist()], pa.string())
                            found = [(*row[:5], None, v["values"], v["counts"])
                                     for v in pc.value_counts(column).to_pylist()
                                     if v["values"] is not None]
                            if found:
                                yield batch(found)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet") \
        .option("recursiveFileLookup", "true").load(base).select("path") \
        .mapInArrow(footers, _FOUND)


def schema_drift_files(spark: SparkSession, base: str, expected: T.StructType) -> DataFrame:
    """Drift of an entity's landed files by run date: one row per ``run_date``, column, issue and
    landed type, with the files and rows concerned and the ``bad_values``: values of a column of
    another type that do not convert to the declared one (NULLs are no bad values). Files of one
    day may differ. ``run_date`` is NULL for files outside ``year=/month=/day=`` folders; a folder
    without Parquet files gives no rows."""
    def part(key: str):
        return F.nullif(F.regexp_extract("path", f"/{key}=([0-9]+)/", 1), F.lit(""))

    bad = F.lit(False)
    for dtype in {f.dataType.simpleString(): f.dataType for f in expected.fields}.values():
        if not isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
            bad = F.when(F.col("expected_type") == dtype.simpleString(),
                         F.col("value").try_cast(dtype).isNull()).otherwise(bad)
        else:
            bad = F.when(F.col("expected_type") == dtype.simpleString(), F.lit(True)).otherwise(bad)
    is_file = F.col("n_rows").isNotNull()
    year, month, day = part("year"), part("month"), part("day")
    return file_columns(spark, base, expected).groupBy(
        F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(),
               F.concat_ws("-", year, month, day)).alias("run_date"),
        "column_name", "issue", "expected_type", "landed_type").agg(
        F.count_if(is_file).alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
        F.coalesce(F.sum(F.when(~is_file & bad, F.col("n_values"))), F.lit(0)).cast("bigint")
         .alias("bad_values"))
