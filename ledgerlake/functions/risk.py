"""Fraud-score rules: flag, rounding, reason codes, tiers, priority and action."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerlake.constants import (
    ACTION_IMMEDIATE, ACTION_MONITOR, ACTION_NONE, FRAUD_MODEL_VERSION, FRAUD_REASON_RULES,
    RISK_PRIORITY,
    RISK_PRIORITY_DEFAULT, RISK_TIER_DEFAULT, RISK_TIERS,
)
from ledgerlake.params import DEFAULT, Params


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_flagged_score(score, params: Params = DEFAULT) -> Column:
    """Flag on the *unrounded* score (inclusive threshold)."""
    return _c(score) >= F.lit(params.fraud_score_threshold)


def round_score(score) -> Column:
    """Stored score: rounded to 4 decimal places."""
    return F.round(_c(score), 4)


def fraud_reasons(score) -> Column:
    """Reason codes, one per strictly exceeded threshold, in threshold order."""
    s = _c(score)
    return F.array_compact(F.array(*[F.when(s > F.lit(t), F.lit(code)) for t, code in FRAUD_REASON_RULES]))


def risk_tier(score_dec) -> Column:
    """Searched CASE on the DECIMAL(6,4) score; NULL falls to the default tier."""
    s = _c(score_dec)
    expr = None
    for bound, tier in RISK_TIERS:
        cond = s >= F.lit(bound).cast("decimal(6,4)")
        expr = F.when(cond, F.lit(tier)) if expr is None else expr.when(cond, F.lit(tier))
    return expr.otherwise(F.lit(RISK_TIER_DEFAULT))


def risk_priority(tier) -> Column:
    t = _c(tier)
    expr = None
    for name, prio in RISK_PRIORITY.items():
        expr = F.when(t == name, F.lit(prio)) if expr is None else expr.when(t == name, F.lit(prio))
    return expr.otherwise(F.lit(RISK_PRIORITY_DEFAULT))


def recommended_action(tier) -> Column:
    t = _c(tier)
    return (F.when(t.isin("critical", "high"), F.lit(ACTION_IMMEDIATE))
            .when(t == "medium", F.lit(ACTION_MONITOR))
            .otherwise(F.lit(ACTION_NONE)))


def reasons_text(reasons, sep: str = "|") -> Column:
    """Array of codes -> text for the warehouse column; NULL stays NULL."""
    return F.array_join(_c(reasons), sep)


def signal_columns(score, params: Params = DEFAULT) -> list[Column]:
    """A scorer's output record from an unrounded score: the stored (rounded) score, the
    flag and the reason codes (both decided on the unrounded value), the model version."""
    s = _c(score)
    return [
        round_score(s).alias("fraud_score"),
        is_flagged_score(s, params).alias("is_flagged"),
        fraud_reasons(s).alias("fraud_reasons"),
        F.lit(FRAUD_MODEL_VERSION).alias("model_version"),
    ]
