"""Explicit schemas for every table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B, TS, DT, L, I = (
    T.StringType(), T.DoubleType(), T.BooleanType(), T.TimestampType(), T.DateType(),
    T.LongType(), T.IntegerType(),
)


def _struct(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


# -- raw (landed) ---------------------------------------------------------------------------
RAW_TRANSACTIONS = _struct(
    ("transaction_id", S, True), ("account_id", S, True), ("amount", D, True),
    ("currency", S, True), ("transaction_type", S, True), ("merchant_id", S, True),
    ("timestamp", S, True), ("status", S, True), ("region", S, True), ("channel", S, True),
    ("ip_address", S, True), ("device_id", S, True), ("ingested_at", S, True),
)

RAW_FRAUD_SIGNALS = _struct(
    ("transaction_id", S, True), ("fraud_score", D, True), ("is_flagged", B, True),
    ("fraud_reasons", T.ArrayType(S, True), True), ("model_version", S, True),
    ("scored_at", S, True),
)

# -- staged models ----------------------------------------------------------------------------
STG_TRANSACTIONS = _struct(
    ("transaction_id", S, True), ("account_id", S, True), ("merchant_id", S, True),
    ("amount_usd", dec(18, 2), True), ("currency_code", S, True), ("transaction_type", S, True),
    ("transaction_status", S, True), ("region", S, True), ("channel", S, True),
    ("transaction_at", TS, True), ("transaction_date", DT, True), ("transaction_hour", I, True),
    ("is_large_transaction", B, False), ("ingested_at", TS, True), ("model_updated_at", TS, False),
)

STG_FRAUD_SIGNALS = _struct(
    ("transaction_id", S, True), ("fraud_score", dec(6, 4), True), ("is_flagged", B, True),
    ("risk_tier", S, False), ("fraud_reasons", T.ArrayType(S, True), True),
    ("model_version", S, True), ("scored_at", TS, True), ("model_updated_at", TS, False),
)

# -- warehouse tables, by version -------------------------------------------------------------
_TXN_V1 = [
    ("transaction_id", S, False), ("account_id", S, False), ("merchant_id", S, True),
    ("amount_usd", dec(18, 2), False), ("currency_code", S, False), ("transaction_type", S, False),
    ("transaction_status", S, False), ("region", S, True), ("channel", S, True),
    ("transaction_at", TS, False), ("transaction_date", DT, False),
    ("is_large_transaction", B, False), ("ingested_at", TS, False),
    ("created_at", TS, True), ("updated_at", TS, True),
]
_TXN_V2_ADD = [
    ("fraud_score", dec(6, 4), True), ("risk_tier", S, True),
    ("is_fraud_flagged", B, False), ("requires_review", B, False),
]
_TXN_V3_ADD = [
    ("aml_flag", B, False), ("compliance_notes", S, True), ("reviewed_by", S, True),
    ("reviewed_at", TS, True),
]

FRAUD_SIGNALS_TABLE = _struct(
    ("id", L, False), ("transaction_id", S, False), ("fraud_score", dec(6, 4), False),
    ("is_flagged", B, False), ("risk_tier", S, True), ("fraud_reasons", S, True),
    ("model_version", S, True), ("scored_at", TS, False), ("created_at", TS, True),
)

PIPELINE_RUNS = _struct(
    ("run_id", S, False), ("pipeline_name", S, False), ("partition_date", DT, False),
    ("status", S, False), ("rows_ingested", L, True), ("rows_failed", L, True),
    ("duration_seconds", dec(8, 2), True), ("error_message", S, True),
    ("started_at", TS, False), ("completed_at", TS, True),
)

COMPLIANCE_REPORTS = _struct(
    ("report_id", S, False), ("report_type", S, False), ("transaction_id", S, False),
    ("account_id", S, False), ("amount_usd", dec(18, 2), False), ("reason", S, True),
    ("status", S, False), ("submitted_at", TS, True), ("created_at", TS, True),
)

WAREHOUSE = {
    1: {
        "transactions": _struct(*_TXN_V1),
        "fraud_signals": FRAUD_SIGNALS_TABLE,
        "pipeline_runs": PIPELINE_RUNS,
    },
    2: {
        "transactions": _struct(*_TXN_V1, *_TXN_V2_ADD),
        "fraud_signals": FRAUD_SIGNALS_TABLE,
        "pipeline_runs": PIPELINE_RUNS,
    },
    3: {
        "transactions": _struct(*_TXN_V1, *_TXN_V2_ADD, *_TXN_V3_ADD),
        "fraud_signals": FRAUD_SIGNALS_TABLE,
        "pipeline_runs": PIPELINE_RUNS,
        "compliance_reports": COMPLIANCE_REPORTS,
    },
}

# Declared column defaults per warehouse table (rows written before a column existed, or
# inserted without it, read these). created_at / updated_at default to now() where present.
COLUMN_DEFAULTS = {
    "transactions": {"is_large_transaction": False, "is_fraud_flagged": False,
                     "requires_review": False, "aml_flag": False},
    "fraud_signals": {"is_flagged": False},
    "pipeline_runs": {},
    "compliance_reports": {"status": "pending"},
}
NOW_DEFAULTS = {
    "transactions": {"created_at", "updated_at"},
    "fraud_signals": {"created_at"},
    "pipeline_runs": set(),
    "compliance_reports": {"created_at"},
}

PRIMARY_KEYS = {
    "transactions": ["transaction_id"], "fraud_signals": ["id"],
    "pipeline_runs": ["run_id"], "compliance_reports": ["report_id"],
}
FOREIGN_KEYS = {
    "fraud_signals": [("transaction_id", "transactions", "transaction_id")],
    "compliance_reports": [("transaction_id", "transactions", "transaction_id")],
}
