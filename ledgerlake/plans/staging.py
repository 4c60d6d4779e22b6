"""Staging models: typed, renamed, trimmed views over the raw feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.functions.cleaning import lower_trim, to_amount, to_ts, upper_trim
from ledgerlake.functions.risk import risk_tier
from ledgerlake.params import DEFAULT, Params


def _now(updated_at: Column | None) -> Column:
    # One value per query; tests inject a literal to make outputs reproducible.
    return updated_at if updated_at is not None else F.current_timestamp()


def stg_transactions(raw: DataFrame, params: Params = DEFAULT,
                     updated_at: Column | None = None) -> DataFrame:
    """Cleaned transactions. Rows without id/account/amount, or with an amount that rounds
    below zero, are dropped (the decimal test runs after rounding, so -0.004 passes)."""
    amount = to_amount("amount")
    at = to_ts("timestamp")
    kept = raw.filter(
        F.col("transaction_id").isNotNull()
        & F.col("account_id").isNotNull()
        & F.col("amount").isNotNull()
        & (amount >= 0)
    )
    return kept.select(
        "transaction_id",
        "account_id",
        "merchant_id",
        amount.alias("amount_usd"),
        upper_trim("currency").alias("currency_code"),
        lower_trim("transaction_type").alias("transaction_type"),
        lower_trim("status").alias("transaction_status"),
        upper_trim("region").alias("region"),
        lower_trim("channel").alias("channel"),
        at.alias("transaction_at"),
        F.to_date(at).alias("transaction_date"),
        F.hour(at).alias("transaction_hour"),
        F.when(amount >= F.lit(params.large_txn_threshold), F.lit(True))
         .otherwise(F.lit(False)).alias("is_large_transaction"),
        to_ts("ingested_at").alias("ingested_at"),
        _now(updated_at).alias("model_updated_at"),
    )


def stg_fraud_signals(raw: DataFrame, params: Params = DEFAULT,
                      updated_at: Column | None = None) -> DataFrame:
    """Cleaned fraud signals with a risk tier from the DECIMAL(6,4) score."""
    score = F.col("fraud_score").cast("decimal(6,4)")
    return raw.filter(F.col("transaction_id").isNotNull()).select(
        "transaction_id",
        score.alias("fraud_score"),
        F.col("is_flagged").cast("boolean").alias("is_flagged"),
        risk_tier(score).alias("risk_tier"),
        "fraud_reasons",
        "model_version",
        to_ts("scored_at").alias("scored_at"),
        _now(updated_at).alias("model_updated_at"),
    )


def apply_lookback(stg: DataFrame, as_of_date: Column, params: Params = DEFAULT) -> DataFrame:
    """Optional event-date window (``lookback_days``); off unless ``params.apply_lookback``."""
    if not params.apply_lookback:
        return stg
    return stg.filter(F.col("transaction_date") >= F.date_sub(as_of_date, params.lookback_days))
