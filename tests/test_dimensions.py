import datetime as dt
from decimal import Decimal

from ledgerlake.operators.dimensions import normalise_to_usd, with_accounts
from ledgerlake.params import Params
from ledgerlake.plans.staging import stg_transactions
from tests.helpers import raw_txn_df, txn
from tests.test_skew import no_broadcast


def _stg(spark):
    return stg_transactions(raw_txn_df(spark, [
        txn("u", currency="USD", amount=10.0), txn("e", currency=" eur ", amount=10.0),
        txn("g", currency="GBP", amount=3.0, account_id="A2"),
        txn("j", currency="JPY", amount=1000.0, account_id="A3")]))


def _rates(spark):
    return spark.createDataFrame(
        [("EUR", dt.date(2025, 5, 16), Decimal("1.08500000")),
         ("GBP", dt.date(2025, 5, 16), Decimal("1.26000000")),
         ("EUR", dt.date(2025, 5, 15), Decimal("9.99"))],
        "currency_code string, rate_date date, usd_per_unit decimal(18,8)")


def _check(rows):
    out = {r["transaction_id"]: r for r in rows}
    assert out["u"]["amount_usd_converted"] == Decimal("10.00")
    assert out["e"]["amount_usd_converted"] == Decimal("10.85")
    assert out["g"]["amount_usd_converted"] == Decimal("3.78")
    assert out["j"]["amount_usd_converted"] is None and len(out) == 4


def test_fx_normalisation_broadcast_and_shuffle_agree(spark):
    _check(normalise_to_usd(_stg(spark), _rates(spark)).collect())
    with no_broadcast(spark):
        _check(normalise_to_usd(_stg(spark), _rates(spark), params=Params(hot_key_rows=1)).collect())


def test_fx_takes_the_last_rate_known_on_the_day(spark):
    def day(d):
        return f"2025-05-{d:02d}T01:00:00"
    stg = stg_transactions(raw_txn_df(spark, [
        txn("before", currency="EUR", timestamp=day(1)), txn("on", currency="EUR", timestamp=day(3)),
        txn("gap", currency="EUR", timestamp=day(9)), txn("next", currency="EUR", timestamp=day(10)),
        txn("nowhen", currency="EUR", timestamp=None), txn("nocur", currency=None),
        txn("nowhen usd", currency="USD", timestamp=None)]))
    rates = spark.createDataFrame(
        [("eur ", dt.date(2025, 5, 3), Decimal(2)), ("EUR", dt.date(2025, 5, 10), Decimal(3)),
         ("EUR", dt.date(2025, 5, 10), None), ("EUR", None, Decimal(9)), (None, dt.date(2025, 5, 1), Decimal(7))],
        "currency_code string, rate_date date, usd_per_unit decimal(18,8)")
    got = {r["transaction_id"]: (r["fx_rate"], r["fx_date"] and r["fx_date"].day)
           for r in normalise_to_usd(stg, rates).collect()}
    assert got == {"before": (None, None), "on": (2, 3), "gap": (2, 3), "next": (3, 10),
                   "nowhen": (None, None), "nocur": (None, None), "nowhen usd": (1, None)}


def test_account_attributes(spark):
    accounts = spark.createDataFrame(
        [("A1", "retail", "2024-01-01"), ("A1", "premium", "2025-01-01"), ("A2", "business", "2020-01-01")],
        "account_id string, segment string, opened string")
    out = {r["transaction_id"]: r["segment"] for r in
           with_accounts(_stg(spark), accounts, ["segment"], order_col="opened").collect()}
    assert out == {"u": "premium", "e": "premium", "g": "business", "j": None}
