"""Fixed values that must equal the reference's for results to match.

Kept together, in the reference's natural order, as plain text.
"""

# Validation vocabularies.
REQUIRED_TRANSACTION_COLS = ["transaction_id", "account_id", "amount", "currency", "timestamp"]
VALID_TRANSACTION_TYPES = ["debit", "credit", "transfer", "withdrawal", "deposit"]
VALID_CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CAD", "AUD", "CHF"]
VALID_STATUSES = ["completed", "pending", "failed", "reversed"]

# Fraud reason codes, each added when the score is strictly above its threshold.
FRAUD_REASON_RULES = [
    (0.5, "velocity_check_failed"),
    (0.6, "unusual_merchant_category"),
    (0.7, "geo_anomaly"),
    (0.8, "device_fingerprint_mismatch"),
    (0.9, "known_fraud_network"),
]
FRAUD_MODEL_VERSION = "fraud-v2.3.1"

# Risk tiers by inclusive lower bound on the DECIMAL(6,4) score, highest first.
RISK_TIERS = [(0.90, "critical"), (0.75, "high"), (0.50, "medium"), (0.25, "low")]
RISK_TIER_DEFAULT = "minimal"
RISK_PRIORITY = {"critical": 1, "high": 2, "medium": 3, "low": 4}
RISK_PRIORITY_DEFAULT = 5
ACTION_IMMEDIATE = "Immediate Action"
ACTION_MONITOR = "Monitor"
ACTION_NONE = "No Action"

# Compliance report types named in the warehouse DDL.
REPORT_CTR = "CTR"
REPORT_SAR = "SAR"
REPORT_STATUS_DEFAULT = "pending"

# Warehouse string length limits (column -> max length).
TRANSACTIONS_LENGTHS = {
    "transaction_id": 36, "account_id": 36, "merchant_id": 36, "currency_code": 3,
    "transaction_type": 20, "transaction_status": 20, "region": 20, "channel": 20,
    "risk_tier": 10, "reviewed_by": 100,
}
FRAUD_SIGNALS_LENGTHS = {"transaction_id": 36, "risk_tier": 10, "model_version": 20}
PIPELINE_RUNS_LENGTHS = {"run_id": 36, "pipeline_name": 100, "status": 20}
COMPLIANCE_REPORTS_LENGTHS = {
    "report_id": 36, "report_type": 50, "transaction_id": 36, "account_id": 36, "status": 20,
}
