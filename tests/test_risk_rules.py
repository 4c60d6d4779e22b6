import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.risk import (
    fraud_reasons, is_flagged_score, recommended_action, risk_priority, round_score,
)


@pytest.mark.parametrize("score,codes", [
    (0.1, []), (0.3, []), (0.5, []), (0.5001, ["velocity_check_failed"]),
    (0.65, ["velocity_check_failed", "unusual_merchant_category"]),
    (0.8, ["velocity_check_failed", "unusual_merchant_category", "geo_anomaly"]),
    (0.95, ["velocity_check_failed", "unusual_merchant_category", "geo_anomaly",
            "device_fingerprint_mismatch", "known_fraud_network"]),
])
def test_reason_codes_strict_thresholds(spark, score, codes):
    r = spark.range(1).select(fraud_reasons(F.lit(score)).alias("r")).collect()[0]["r"]
    assert r == codes


def test_flag_and_round(spark):
    r = spark.range(1).select(
        is_flagged_score(F.lit(0.74996)).alias("f1"), is_flagged_score(F.lit(0.75)).alias("f2"),
        round_score(F.lit(0.74996)).alias("r")).collect()[0]
    assert r["f1"] is False and r["f2"] is True and abs(r["r"] - 0.75) < 1e-12


@pytest.mark.parametrize("tier,prio,action", [
    ("critical", 1, "Immediate Action"), ("high", 2, "Immediate Action"),
    ("medium", 3, "Monitor"), ("low", 4, "No Action"), ("minimal", 5, "No Action"),
])
def test_priority_and_action(spark, tier, prio, action):
    r = spark.range(1).select(risk_priority(F.lit(tier)).alias("p"),
                              recommended_action(F.lit(tier)).alias("a")).collect()[0]
    assert (r["p"], r["a"]) == (prio, action)
