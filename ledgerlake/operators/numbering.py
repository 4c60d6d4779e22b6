"""Dense numbers for the rows of a distributed table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F


def checkpointed(df: DataFrame, name: str) -> DataFrame:
    return df.checkpoint()


def number_rows(df: DataFrame, order: list[str], column: str, first: int = 1,
                cut: Callable[[DataFrame, str], DataFrame] = checkpointed) -> DataFrame:
    """``df`` with ``column``: first, first + 1, ... in the sort order of ``order``.

    Rows are sorted by ranges and numbered where they lie; each partition's numbers are then
    shifted by the rows of the partitions before it. ``cut`` writes the sorted rows once, so that
    a task that is run again finds the same partitions. Only the row counts of the partitions meet
    in one task, and are broadcast: there are as many as shuffle partitions."""
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("_place", F.monotonically_increasing_id()), f"{column}_placed")
    part = F.shiftright("_place", 33)  # the partition's index is above the row's
    parts = placed.groupBy(part.alias("_part")).agg(F.min("_place").alias("_first"),
                                                    F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + first
                                    - F.col("_first")).alias("_shift"))
    return placed.withColumn("_part", part).join(F.broadcast(shifts), "_part") \
        .withColumn(column, F.col("_place") + F.col("_shift")).drop("_part", "_place", "_shift")
