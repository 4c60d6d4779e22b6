"""Dimension lookups: account attributes (X11) and FX normalisation to USD (X12).

The reference names an account feed and an FX-rate feed but gives neither columns nor data;
these operators take whatever dimension the caller supplies. A dimension is never hinted to be
broadcast: Spark decides by its size. A key with very many facts is salted over several tasks
(``lookup_join``), for which the facts are counted by key, combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlake.operators.joins import lookup_join
from ledgerlake.params import DEFAULT, Params


def _attach(facts: DataFrame, dim: DataFrame, keys: list[str], params: Params) -> DataFrame:
    """LEFT JOIN to a dimension with one row per key and the number of its facts (``_n``)."""
    return lookup_join(facts, dim, keys, count_col="_n", hot_rows=params.hot_key_rows) \
        .drop("_n").select(*facts.columns, *[c for c in dim.columns if c not in (*keys, "_n")])


def with_accounts(df: DataFrame, accounts: DataFrame, columns: list[str],
                  order_col: str | None = None, params: Params = DEFAULT) -> DataFrame:
    """Attach account attributes (``columns``) by ``account_id``; unknown accounts get NULLs.
    Several rows per account in the feed are reduced first to the one with the largest
    ``order_col`` (e.g. an update time) - a grouped ``max`` over a struct, partial-aggregated."""
    lead = [F.col(order_col)] if order_col else []
    latest = accounts.groupBy("account_id").agg(
        F.max(F.struct(*lead, *[F.col(c) for c in columns])).alias("_a"))
    counts = df.groupBy("account_id").agg(F.count(F.lit(1)).alias("_n"))
    dim = latest.join(counts, "account_id").select(
        "account_id", *[F.col(f"_a.{c}").alias(c) for c in columns], "_n")
    return _attach(df, dim, ["account_id"], params)


def normalise_to_usd(stg: DataFrame, rates: DataFrame, base: str = "USD",
                     params: Params = DEFAULT) -> DataFrame:
    """Convert ``amount_usd`` (which staging only renames) with a rate table ``(currency_code,
    rate_date, usd_per_unit)`` that may lack days: a transaction takes the last rate known on its
    date (``fx_date`` tells of when). The base currency converts at 1. Without an earlier rate, a
    currency or a date the converted amount is NULL; the row is kept. Of several rates of one day
    the largest counts.

    The as-of join is over dates, not transactions: the (currency, date) pairs that occur and
    the rates are one table, and a window carries the last rate forward. A currency's partition is
    as long as it has dates."""
    known = rates.groupBy(F.upper(F.trim("currency_code")).alias("currency_code"),
                          F.col("rate_date").cast("date").alias("transaction_date")) \
        .agg(F.max(F.col("usd_per_unit").cast("decimal(18,8)")).alias("_rate")) \
        .filter("_rate IS NOT NULL AND transaction_date IS NOT NULL")
    wanted = stg.groupBy("currency_code", "transaction_date").agg(F.count(F.lit(1)).alias("_n"))
    dates = known.unionByName(wanted, allowMissingColumns=True) \
        .groupBy("currency_code", "transaction_date") \
        .agg(F.max("_rate").alias("_rate"), F.max("_n").alias("_n"))
    so_far = Window.partitionBy("currency_code").orderBy("transaction_date") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lookup = dates.select(
        "currency_code", "transaction_date", "_n",
        F.last("_rate", ignorenulls=True).over(so_far).alias("_fx"),
        F.last(F.when(F.col("_rate").isNotNull(), F.col("transaction_date")), ignorenulls=True)
         .over(so_far).alias("_fx_date")).filter(F.col("_n").isNotNull())
    joined = _attach(stg, lookup, ["currency_code", "transaction_date"], params)
    is_base = F.col("currency_code") == base
    rate = F.when(is_base, F.lit(1).cast("decimal(18,8)")).otherwise(F.col("_fx"))
    return joined.select(
        *stg.columns, rate.alias("fx_rate"),
        F.when(is_base, F.col("transaction_date")).otherwise(F.col("_fx_date")).alias("fx_date"),
        F.round(F.col("amount_usd") * rate, 2).cast("decimal(18,2)").alias("amount_usd_converted"))
