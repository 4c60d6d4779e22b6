"""Data tests over the model DAG: not_null, unique, accepted_values, relationships.

Output ``(model, column_name, test, failures, status)``; one row per test. Tests on the same
model share one aggregate pass; ``unique`` is a grouped count and ``relationships`` an
anti-join, so every test scales with the table and never collects a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlake.constants import RISK_TIER_DEFAULT, RISK_TIERS, VALID_CURRENCIES, \
    VALID_STATUSES, VALID_TRANSACTION_TYPES, ACTION_IMMEDIATE, ACTION_MONITOR, ACTION_NONE
from ledgerlake.operators.constraints import (
    model_tests, relationships_test, union_all, with_status,
)
from ledgerlake.plans.marts import SUMMARY_KEYS

TIERS = [t for _, t in RISK_TIERS] + [RISK_TIER_DEFAULT]
WARN_ON = (("stg_transactions", "currency_code", "accepted_values"),
           ("stg_transactions", "transaction_status", "accepted_values"))


def accepted_values_tests(stg_txn: DataFrame, stg_fraud: DataFrame) -> DataFrame:
    return union_all([
        model_tests(stg_txn, "stg_transactions", [], {
            "transaction_type": VALID_TRANSACTION_TYPES,
            "transaction_status": VALID_STATUSES,
            "currency_code": VALID_CURRENCIES,
        }),
        model_tests(stg_fraud, "stg_fraud_signals", [], {"risk_tier": TIERS}),
    ])


def data_tests_report(stg_txn: DataFrame, stg_fraud: DataFrame, enriched: DataFrame,
                      summary: DataFrame, fraud_mart: DataFrame) -> DataFrame:
    """One pass per model plus one anti-join for the relationship test. Pass materialised
    models (tables, or checkpointed DataFrames) so each model is read, not recomputed."""
    tests = [
        model_tests(stg_txn, "stg_transactions",
                    ["transaction_id", "account_id", "amount_usd", "transaction_at"], {
                        "transaction_type": VALID_TRANSACTION_TYPES,
                        "transaction_status": VALID_STATUSES,
                        "currency_code": VALID_CURRENCIES,
                    }),
        model_tests(stg_fraud, "stg_fraud_signals", ["transaction_id", "fraud_score"],
                    {"risk_tier": TIERS}),
        relationships_test(stg_fraud, stg_txn, "stg_fraud_signals", "transaction_id"),
        model_tests(enriched, "int_transactions_enriched", ["fraud_score", "risk_tier"],
                    unique=["transaction_id"]),
        model_tests(summary, "mart_transaction_summary", ["transaction_count"],
                    unique=SUMMARY_KEYS),
        model_tests(fraud_mart, "mart_fraud_detection", ["transaction_id"], {
            "risk_priority": [1, 2, 3, 4, 5],
            "recommended_action": [ACTION_IMMEDIATE, ACTION_MONITOR, ACTION_NONE],
        }, unique=["transaction_id"]),
    ]
    return with_status(union_all(tests), WARN_ON)
