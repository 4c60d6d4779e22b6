"""Typing and normalisation expressions used by the staging models."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_amount(col="amount") -> Column:
    """Raw double amount -> DECIMAL(18,2) (HALF_UP); NaN becomes NULL."""
    return _c(col).cast("decimal(18,2)")


def upper_trim(col) -> Column:
    """UPPER(TRIM(x)); trims spaces only, like SQL TRIM."""
    return F.upper(F.trim(_c(col)))


def lower_trim(col) -> Column:
    return F.lower(F.trim(_c(col)))


def to_ts(col, strict: bool = True) -> Column:
    """ISO-8601 string -> TIMESTAMP. Strict casts raise on malformed input (models);
    the lenient form yields NULL (validation / quarantine path)."""
    c = _c(col)
    return c.cast("timestamp") if strict else c.try_cast("timestamp")


def nan_to_null(col) -> Column:
    """pandas treats NaN as missing; Spark does not. Normalise before null/compare rules."""
    return F.nanvl(_c(col), F.lit(None).cast("double"))
