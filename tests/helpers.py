"""Hand-made raw rows for operator tests."""

from ledgerlake.schemas import RAW_FRAUD_SIGNALS, RAW_TRANSACTIONS


def txn(transaction_id="t1", account_id="A1", amount=10.0, currency="USD",
        transaction_type="debit", merchant_id="M1", timestamp="2025-05-16T10:20:30.123456",
        status="completed", region="EU", channel="web", ip_address="1.1.1.1",
        device_id="DEV_1", ingested_at="2025-05-16T10:35:00"):
    return (transaction_id, account_id, amount, currency, transaction_type, merchant_id,
            timestamp, status, region, channel, ip_address, device_id, ingested_at)


def sig(transaction_id="t1", fraud_score=0.1, is_flagged=None, fraud_reasons=None,
        model_version="fraud-v2.3.1", scored_at="2025-05-16T11:00:00"):
    if is_flagged is None:
        is_flagged = fraud_score is not None and fraud_score >= 0.75
    return (transaction_id, fraud_score, is_flagged, fraud_reasons or [], model_version, scored_at)


def raw_txn_df(spark, rows):
    return spark.createDataFrame(rows, RAW_TRANSACTIONS)


def raw_sig_df(spark, rows):
    return spark.createDataFrame(rows, RAW_FRAUD_SIGNALS)
