"""Constraint checks (NOT NULL, length, primary key, foreign key) and the data-test report.

Every check is an aggregate or an anti-join over the whole table; results are small
DataFrames of violations. Several checks on one table share one aggregate pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.operators.joins import orphans
from ledgerlake.schemas import WAREHOUSE

REPORT_COLS = ["model", "column_name", "test", "failures"]


def _unpivot_counts(counts: DataFrame, names: list[str], table: str, test: str) -> DataFrame:
    """One-row counts -> one row per checked column (long form)."""
    if not names:
        return counts.sparkSession.createDataFrame([], "model string, column_name string, "
                                                        "test string, failures bigint")
    stacked = F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").cast("bigint").alias("failures"))
        for n in names]))
    return counts.select(stacked.alias("s")).select(
        F.lit(table).alias("model"), "s.column_name", F.lit(test).alias("test"), "s.failures")


def not_null_violations(df: DataFrame, table: str, version: int = 3) -> DataFrame:
    """Rows with NULL in each NOT NULL column of the table version."""
    cols = [f.name for f in WAREHOUSE[version][table].fields
            if not f.nullable and f.name in df.columns]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _unpivot_counts(counts, cols, table, "not_null")


def length_violations(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """Rows whose string is longer than the column's declared length."""
    cols = [c for c in limits if c in df.columns]
    counts = df.agg(*[F.count_if(F.length(c) > limits[c]).alias(c) for c in cols])
    return _unpivot_counts(counts, cols, table, "max_length")


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values occurring more than once (grouped count, partial-aggregated), with the
    number of rows per value. NULL keys are reported too: a key column is NOT NULL."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1))


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return orphans(child, parent, child_key, parent_key)


# -- data tests over models (not_null / unique / accepted_values / relationships) ----------------

def model_tests(df: DataFrame, model: str, not_null: list[str] = (),
                accepted: dict | None = None, unique: list[str] | None = None) -> DataFrame:
    """Every not_null / accepted_values / unique test of one model in one two-phase pass.

    With a unique key, rows are grouped by it (partial aggregation first, so a repeated key
    is combined map-side) carrying per-group counts of NULLs and rejected values; a global
    aggregate then sums those and counts the groups seen more than once. Without one it is
    a single global aggregate. Usual data-test semantics: accepted_values ignores NULLs; a
    single-column unique test ignores NULL keys.
    """
    accepted = accepted or {}
    checks = [(f"nn:{c}", "not_null", c, F.col(c).isNull()) for c in not_null]
    checks += [(f"av:{c}", "accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(*v))
               for c, v in accepted.items()]
    if unique:
        grouped = df.groupBy(*unique).agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.count_if(cond).alias(name) for name, _, _, cond in checks])
        dup = F.col("_n") > 1
        if len(unique) == 1:
            dup = dup & F.col(unique[0]).isNotNull()
        counts = grouped.agg(
            F.count_if(dup).alias("uq"),
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name, _, _, _ in checks])
        entries = [(name, test, col) for name, test, col, _ in checks]
        entries.append(("uq", "unique", "+".join(unique)))
    else:
        counts = df.agg(*[F.count_if(cond).alias(name) for name, _, _, cond in checks])
        entries = [(name, test, col) for name, test, col, _ in checks]
    stacked = F.explode(F.array(*[
        F.struct(F.lit(col).alias("column_name"), F.lit(test).alias("test"),
                 F.col(f"`{name}`").cast("bigint").alias("failures"))
        for name, test, col in entries]))
    return counts.select(stacked.alias("s")).select(
        F.lit(model).alias("model"), "s.column_name", "s.test", "s.failures")


def relationships_test(child: DataFrame, parent: DataFrame, model: str, col: str,
                       parent_col: str | None = None) -> DataFrame:
    """Relationships test: child rows whose non-NULL key has no parent row."""
    o = orphans(child, parent, col, parent_col or col)
    return o.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(col).alias("column_name"),
        F.lit("relationships").alias("test"), "failures")


def with_status(report: DataFrame, warn_on: tuple[tuple[str, str, str], ...] = ()) -> DataFrame:
    """pass when no failures; warn for the (model, column, test) triples in ``warn_on``."""
    is_warn = F.lit(False)
    for m, c, t in warn_on:
        is_warn = is_warn | ((F.col("model") == m) & (F.col("column_name") == c)
                             & (F.col("test") == t))
    status: Column = (F.when(F.col("failures") == 0, F.lit("pass"))
                      .when(is_warn, F.lit("warn"))
                      .otherwise(F.lit("fail")))
    return report.withColumn("status", status)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
