import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans.staging import stg_fraud_signals, stg_transactions
from tests.helpers import raw_sig_df, raw_txn_df, sig, txn


def _by_id(df):
    return {r["transaction_id"]: r for r in df.collect()}


def test_amount_rounding_filter_and_large_flag(spark):
    rows = [txn("nan", amount=float("nan")), txn("null", amount=None), txn("neg", amount=-0.004),
            txn("neg2", amount=-0.01), txn("zero", amount=0.0), txn("a", amount=9999.994),
            txn("b", amount=9999.995), txn("c", amount=10000.0), txn("d", amount=1000000.01)]
    out = _by_id(stg_transactions(raw_txn_df(spark, rows)))
    assert "nan" not in out and "null" not in out and "neg2" not in out
    assert out["neg"]["amount_usd"] == Decimal("0.00")          # rounds before the >= 0 test
    assert out["a"]["amount_usd"] == Decimal("9999.99") and not out["a"]["is_large_transaction"]
    assert out["b"]["amount_usd"] == Decimal("10000.00") and out["b"]["is_large_transaction"]
    assert out["c"]["is_large_transaction"] and out["d"]["is_large_transaction"]
    assert not out["zero"]["is_large_transaction"]


def test_required_keys_filter(spark):
    rows = [txn(None), txn("x", account_id=None), txn("ok")]
    assert sorted(_by_id(stg_transactions(raw_txn_df(spark, rows)))) == ["ok"]


def test_string_cleaning_and_time_parts(spark):
    rows = [txn("s", transaction_type=" Debit ", currency="USD\t", region="us-east",
                status="Pending", channel="ATM")]
    r = _by_id(stg_transactions(raw_txn_df(spark, rows)))["s"]
    assert r["transaction_type"] == "debit"
    assert r["currency_code"] == "USD\t"        # TRIM strips spaces only
    assert r["region"] == "US-EAST" and r["transaction_status"] == "pending"
    assert r["channel"] == "atm"
    assert r["transaction_at"] == dt.datetime(2025, 5, 16, 10, 20, 30, 123456)
    assert r["transaction_date"] == dt.date(2025, 5, 16) and r["transaction_hour"] == 10


def test_malformed_timestamp_raises_in_model(spark):
    df = stg_transactions(raw_txn_df(spark, [txn("bad", timestamp="not-a-time")]))
    with pytest.raises(Exception):
        df.collect()


def test_null_timestamp_kept_with_null_parts(spark):
    r = _by_id(stg_transactions(raw_txn_df(spark, [txn("n", timestamp=None)])))["n"]
    assert r["transaction_at"] is None and r["transaction_hour"] is None


@pytest.mark.parametrize("score,tier", [
    (0.2499, "minimal"), (0.25, "low"), (0.4999, "low"), (0.5, "medium"), (0.7499, "medium"),
    (0.74996, "high"), (0.75, "high"), (0.8999, "high"), (0.9, "critical"), (None, "minimal"),
])
def test_risk_tiers_on_decimal_score(spark, score, tier):
    out = stg_fraud_signals(raw_sig_df(spark, [sig("t", score)])).collect()[0]
    assert out["risk_tier"] == tier


def test_flag_kept_from_unrounded_score(spark):
    # 0.74996 stores as 0.7500 (tier high) but was not flagged when scored.
    out = stg_fraud_signals(raw_sig_df(spark, [sig("t", 0.74996, is_flagged=False)])).collect()[0]
    assert out["fraud_score"] == Decimal("0.7500") and out["is_flagged"] is False


def test_score_overflow_raises(spark):
    df = stg_fraud_signals(raw_sig_df(spark, [sig("t", 100.5)]))
    with pytest.raises(Exception):
        df.collect()


def test_signal_without_id_dropped(spark):
    assert stg_fraud_signals(raw_sig_df(spark, [sig(None), sig("x")])) \
        .filter(F.col("transaction_id").isNull()).count() == 0
