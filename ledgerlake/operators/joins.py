"""Join helpers: many-to-one lookups, latest-signal selection, orphan (FK) detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup_join(big: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left",
                count_col: str | None = None, hot_rows: int | None = None,
                salt_cols: list[str] | None = None) -> DataFrame:
    """Join a fact table to a table with at most one row per key, safe for hot keys.

    No broadcast hint on ``lookup``: it grows with the data (e.g. hourly velocity). Spark
    broadcasts it only if its size estimate is under ``autoBroadcastJoinThreshold`` (or
    AQE does from real sizes); otherwise it is a sort-merge join.

    When ``lookup`` carries the number of fact rows per key (``count_col``) and
    ``hot_rows`` is set, every key with more than ``hot_rows`` rows is split: it gets
    ``ceil(count / hot_rows)`` salt values; each fact row of a hot key takes a salt from a
    hash of ``salt_cols`` and its input partition id, and the lookup row is replicated
    once per salt. An input split always holds the same rows, so a retried task assigns
    the same salts; identical copies in different splits spread, and copies within one
    split are bounded by the split size. The list of hot keys, the one thing broadcast, has at
    most (fact rows / hot_rows) rows and comes from exact counts, so both sides agree on it.
    Equi-join semantics are kept: NULL keys never match.
    """
    if count_col is None or hot_rows is None:
        return big.join(lookup, on=keys, how=how)
    salts = F.ceil(F.col(count_col) / F.lit(hot_rows)).cast("int")
    hot = F.broadcast(lookup.filter(F.col(count_col) > hot_rows)  # at most rows / hot_rows keys
                      .select(*keys, salts.alias("_salts")))
    salt_src = F.xxhash64(*[F.col(c) for c in (salt_cols or big.columns)],
                          F.spark_partition_id())
    big_s = big.join(hot, on=keys, how="left").select(
        *keys, *[c for c in big.columns if c not in keys],
        F.when(F.col("_salts").isNull(), F.lit(0))
         .otherwise(F.pmod(salt_src, F.col("_salts")).cast("int")).alias("_salt"))
    lookup_s = lookup.join(hot, on=keys, how="left").select(
        *keys, *[c for c in lookup.columns if c not in keys],
        F.explode(F.when(F.col("_salts").isNull(), F.array(F.lit(0)))
                  .otherwise(F.sequence(F.lit(0), F.col("_salts") - 1))).alias("_salt"))
    return big_s.join(lookup_s, on=keys + ["_salt"], how=how).drop("_salt")


def fanout_join(left: DataFrame, right: DataFrame, key: str | list[str],
                hot_rows: int | None = None, salt_cols: list[str] | None = None) -> DataFrame:
    """LEFT JOIN where the *right* side may hold very many rows for one key (e.g. a
    transaction scored over and over), so the hot key cannot be split on the preserved side.
    ``key`` is a column or several.

    Keys with more than ``hot_rows`` rows on the right are found by an exact count, combined
    map-side (at most right rows / hot_rows keys, broadcast). Their right rows take a salt from
    a hash of their columns and input split, and each left row is replicated once per salt.
    After the join, replicas of a hot key that found no right row in their salt are dropped: a
    hot key has right rows, so each left row keeps exactly its matches - the same rows as the
    plain LEFT JOIN.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if hot_rows is None:
        return left.join(right, on=keys, how="left")
    counted = right.dropna(subset=keys).groupBy(*keys) \
        .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    hot = F.broadcast(counted.select(
        *keys, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_salts")))
    left_s = left.join(hot, on=keys, how="left").select(
        *keys, *[c for c in left.columns if c not in keys],
        F.col("_salts").isNotNull().alias("_hot"),
        F.explode(F.when(F.col("_salts").isNull(), F.array(F.lit(0)))
                  .otherwise(F.sequence(F.lit(0), F.col("_salts") - 1))).alias("_salt"))
    salt_src = F.xxhash64(*[F.col(c) for c in (salt_cols or right.columns)],
                          F.spark_partition_id())
    right_s = right.join(hot, on=keys, how="left").select(
        *keys, *[c for c in right.columns if c not in keys],
        F.when(F.col("_salts").isNull(), F.lit(0))
         .otherwise(F.pmod(salt_src, F.col("_salts")).cast("int")).alias("_salt"),
        F.lit(True).alias("_matched"))
    joined = left_s.join(right_s, on=[*keys, "_salt"], how="left")
    return (joined.filter(~F.col("_hot") | F.col("_matched").isNotNull())
            .drop("_salt", "_hot", "_matched"))


def latest_per_key(df: DataFrame, key: str | list[str], order_cols: list[str]) -> DataFrame:
    """One row per ``key`` (a column or several): the row with the largest ``order_cols`` (then the largest
    remaining columns, so ties resolve deterministically).

    Written as a grouped ``max`` over a struct rather than ``row_number()``: the aggregate
    has a partial phase, so a key with very many rows is reduced before the shuffle and no
    single task has to hold or sort a whole group.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + rest]).alias("_best")
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in df.columns if c not in keys]) \
        .select(*df.columns)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose key has no match in ``parent`` (a foreign-key violation).
    NULL child keys are not orphans (SQL FK semantics); check NOT NULL separately."""
    p = parent.select(F.col(parent_key).alias("_pk")).filter(F.col("_pk").isNotNull())
    c = child.filter(F.col(child_key).isNotNull())
    return c.join(p, c[child_key] == p["_pk"], "left_anti")
