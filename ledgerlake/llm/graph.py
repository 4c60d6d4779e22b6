"""Connected components of a distributed edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Scratch


def _with_least(rows: DataFrame, scratch: Scratch, table: str) -> DataFrame:
    """``rows`` with ``m``, the least b of their a. The minima are a table of their own: both
    sides of the join then come straight from shuffles, and AQE splits a very large star."""
    least = scratch.write(rows.groupBy("a").agg(F.min("b").alias("m")), table)
    return rows.join(least, "a")


def star_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of every node that an edge (a, b) names; root is the least of its component.

    Each round hangs all neighbours larger than a node on the least neighbour (large star), then
    all neighbours smaller than a node on their least (small star). It ends when a round changes
    no edge at all, which is compared row by row."""
    state = scratch.write(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), f"{name}-0")
    step, size = 0, state.count()
    while size:
        step += 1
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, scratch, f"{name}-{step}-all").filter("b > a") \
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        large = scratch.write(large, f"{name}-{step}-large")
        hung = _with_least(large, scratch, f"{name}-{step}-least")
        small = hung.select("a", F.col("m").alias("b")).unionByName(
            hung.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        small = scratch.write(small, f"{name}-{step}")
        after = small.count()
        done = after == size and small.join(state, ["a", "b"], "left_anti").isEmpty()
        for table in (f"{step}-all", f"{step}-large", f"{step}-least", f"{step - 1}"):
            scratch.drop(f"{name}-{table}")
        state, size = small, after
        if done:
            break
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
