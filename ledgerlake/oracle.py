"""DuckDB twins of the registered queries (the correctness gate's oracle).

Each entry is an independent ANSI-SQL statement over the pre-registered test views
(``events`` ...). The raw feeds are derived from ``events`` with the same rules as
``ledgerlake.sources.fixtures``; the models are then restated from the model spec. Output
columns follow ``ledgerlake.plans.compare.comparable``: DOUBLE for decimals, ``|``-joined
text for arrays, current-timestamp columns left out.
"""

from __future__ import annotations

# -- raw feeds derived from events -------------------------------------------------------------
RAW_CTES = {
    "ev": "SELECT event_id AS k, ts, user_id, event_type, value FROM events",
    "txn_base": """
SELECT k,
  CAST(k AS VARCHAR) AS transaction_id,
  CASE WHEN k % 151 = 0 THEN NULL WHEN k % 5 = 0 THEN 'ACC_HOT'
       ELSE 'ACC_' || CAST(user_id AS VARCHAR) END AS account_id,
  CASE WHEN k % 97 = 0 THEN -value WHEN k % 113 = 0 THEN CAST(0.0 AS DOUBLE)
       WHEN k % 499 = 0 THEN value * 100000 WHEN k % 50 = 1 THEN value * 1000
       ELSE value * 40 END AS amount,
  CASE WHEN k % 89 = 0 THEN 'BRL' WHEN k % 10 = 3 THEN ' eur ' WHEN k % 10 = 4 THEN 'GBP'
       ELSE 'USD' END AS currency,
  CASE WHEN k % 131 = 0 THEN 'chargeback' WHEN k % 137 = 0 THEN NULL
       WHEN k % 40 = 7 THEN ' Debit '
       WHEN event_type = 'click' THEN 'debit' WHEN event_type = 'view' THEN 'credit'
       WHEN event_type = 'purchase' THEN 'transfer' WHEN event_type = 'signup' THEN 'withdrawal'
       ELSE 'deposit' END AS transaction_type,
  CASE WHEN k % 23 = 0 THEN NULL ELSE 'MERCH_' || CAST(k % 199 AS VARCHAR) END AS merchant_id,
  CAST(make_timestamp(2024, 1, 1 + (day(ts) - 1) % 3, hour(ts), minute(ts), second(ts)) AS VARCHAR)
    AS "timestamp",
  CASE WHEN k % 100 < 90 THEN 'completed' WHEN k % 100 < 97 THEN 'Pending' ELSE 'failed' END
    AS status,
  CASE k % 5 WHEN 0 THEN 'us-east' WHEN 1 THEN 'US-WEST' WHEN 2 THEN 'EU' WHEN 3 THEN 'APAC'
       ELSE 'LATAM' END AS region,
  CASE k % 7 WHEN 0 THEN 'mobile' WHEN 1 THEN 'web' WHEN 2 THEN 'ATM' WHEN 3 THEN 'branch'
       ELSE 'api' END AS channel,
  '10.0.0.1' AS ip_address,
  'DEV_10000' AS device_id,
  CAST(make_timestamp(2024, 1, 1 + (day(ts) - 1) % 3, hour(ts), minute(ts), second(ts))
       + INTERVAL 15 MINUTE AS VARCHAR) AS ingested_at
FROM ev""",
    "raw_transactions": """
SELECT * EXCLUDE (k) FROM txn_base
UNION ALL
SELECT * EXCLUDE (k) FROM txn_base WHERE k % 211 = 0""",
    "sig_scores": """
SELECT k, ts, CAST((k * 7919) % 10000 AS DOUBLE) / 10000 AS s,
       (k * 7919) % 10000 >= 7500 AS flg
FROM ev WHERE k % 3 <> 0
UNION ALL
SELECT k, ts, CAST(0.8 AS DOUBLE) AS s, TRUE AS flg FROM ev WHERE k % 307 = 0""",
    "raw_fraud_signals": """
SELECT CAST(k AS VARCHAR) AS transaction_id, s AS fraud_score, flg AS is_flagged,
  list_filter([CASE WHEN s > 0.5 THEN 'velocity_check_failed' END,
               CASE WHEN s > 0.6 THEN 'unusual_merchant_category' END,
               CASE WHEN s > 0.7 THEN 'geo_anomaly' END,
               CASE WHEN s > 0.8 THEN 'device_fingerprint_mismatch' END,
               CASE WHEN s > 0.9 THEN 'known_fraud_network' END], lambda x: x IS NOT NULL)
    AS fraud_reasons,
  'fraud-v2.3.1' AS model_version,
  CAST(make_timestamp(2024, 1, 1 + (day(ts) - 1) % 3, hour(ts), minute(ts), second(ts))
       + INTERVAL 15 MINUTE AS VARCHAR) AS scored_at
FROM sig_scores""",
    # the same scores as a feed of text, with values that do not convert
    "text_signals": """
SELECT CASE WHEN k % 79 <> 0 THEN CAST(k AS VARCHAR) END AS transaction_id,
  CASE WHEN k % 53 = 0 THEN 'n/a' WHEN k % 59 = 0 THEN '123.0' WHEN k % 61 = 0 THEN NULL
       WHEN k % 67 = 0 THEN 'NaN' ELSE '0.' || lpad(CAST(CAST(round(s * 10000) AS BIGINT) AS VARCHAR), 4, '0')
       END AS fraud_score,
  CASE WHEN k % 83 = 0 THEN 'maybe' ELSE CAST(flg AS VARCHAR) END AS is_flagged,
  CASE WHEN k % 71 = 0 THEN 'yesterday' WHEN k % 73 = 0 THEN NULL ELSE
    CAST(make_timestamp(2024, 1, 1 + (day(ts) - 1) % 3, hour(ts), minute(ts), second(ts))
         + INTERVAL 15 MINUTE AS VARCHAR) END AS scored_at,
  'fraud-v2.3.1' AS model_version
FROM sig_scores""",
}

MODEL_CTES = {
    # what a score's tier says, from its lower bound to below its upper one
    "tiers": """
SELECT * FROM (VALUES
  (0.9000, 100.0000, 'critical', 1, 'Immediate Action'),
  (0.7500, 0.9000, 'high', 2, 'Immediate Action'),
  (0.5000, 0.7500, 'medium', 3, 'Monitor'),
  (0.2500, 0.5000, 'low', 4, 'No Action'),
  (-100.0000, 0.2500, 'minimal', 5, 'No Action')) AS bounds(lowest, below, tier, rank, action)""",
    "stg_transactions": """
SELECT typed.* EXCLUDE (moment), moment AS transaction_at, moment::DATE AS transaction_date,
  datepart('hour', moment)::INTEGER AS transaction_hour, amount_usd >= 10000 AS is_large_transaction
FROM (
  SELECT transaction_id, account_id, merchant_id, amount::DECIMAL(18,2) AS amount_usd,
    upper(trim(currency)) AS currency_code, lower(trim(transaction_type)) AS transaction_type,
    lower(trim(status)) AS transaction_status, upper(trim(region)) AS region,
    lower(trim(channel)) AS channel, "timestamp"::TIMESTAMP AS moment,
    ingested_at::TIMESTAMP AS ingested_at
  FROM raw_transactions) AS typed
WHERE amount_usd >= 0 AND NOT (transaction_id IS NULL OR account_id IS NULL)""",
    "stg_fraud_signals": """
SELECT scored.*, coalesce(tier, 'minimal') AS risk_tier
FROM (
  SELECT transaction_id, fraud_score::DECIMAL(6,4) AS fraud_score, is_flagged, fraud_reasons,
    model_version, scored_at::TIMESTAMP AS scored_at
  FROM raw_fraud_signals) AS scored
LEFT JOIN tiers ON fraud_score >= lowest AND fraud_score < below
WHERE transaction_id IS NOT NULL""",
    "velocity": """
SELECT DISTINCT account_id, transaction_date, transaction_hour,
  count(*) OVER hourly AS txn_count_1h, sum(amount_usd) OVER hourly AS total_amount_1h,
  max(amount_usd) OVER hourly AS max_amount_1h
FROM stg_transactions
WINDOW hourly AS (PARTITION BY account_id, transaction_date, transaction_hour)""",
    # the hour's figures are a window over the rows themselves; without a time there is no hour
    "enriched": """
SELECT *, is_fraud_flagged OR busy OR (is_large_transaction AND fraud_score > 0.4) AS requires_review,
  is_large_transaction OR rich AS aml_flag
FROM (
  SELECT h.*, coalesce(s.fraud_score, 0)::DECIMAL(6,4) AS fraud_score,
    coalesce(s.is_flagged, false) AS is_fraud_flagged, coalesce(s.risk_tier, 'minimal') AS risk_tier,
    s.fraud_reasons, s.model_version AS fraud_model_version,
    coalesce(txn_count_1h > 20, false) AS busy, coalesce(total_amount_1h > 50000, false) AS rich
  FROM (
    SELECT *, if(transaction_at IS NULL, NULL, count(*) OVER hourly) AS txn_count_1h,
      if(transaction_at IS NULL, NULL, sum(amount_usd) OVER hourly) AS total_amount_1h
    FROM stg_transactions
    WINDOW hourly AS (PARTITION BY account_id, date_trunc('hour', transaction_at))) AS h
  LEFT JOIN stg_fraud_signals AS s USING (transaction_id))""",
    "fraud_mart": """
SELECT enriched.*, rank AS risk_priority, action AS recommended_action
FROM enriched JOIN tiers ON tier = risk_tier
WHERE is_fraud_flagged OR requires_review""",
}

MODEL_CTES["flags"] = """
SELECT r.*,
  transaction_id IS NULL AS null_transaction_id,
  account_id IS NULL AS null_account_id,
  (amount IS NULL OR isnan(amount)) AS null_amount,
  currency IS NULL AS null_currency,
  "timestamp" IS NULL AS null_timestamp,
  COUNT(*) OVER (PARTITION BY transaction_id) > 1 AS duplicate_transaction_id,
  COALESCE(amount < 0 AND NOT isnan(amount), FALSE) AS negative_amount,
  COALESCE(transaction_type NOT IN ('debit', 'credit', 'transfer', 'withdrawal', 'deposit'), TRUE)
    AS invalid_transaction_type,
  ("timestamp" IS NOT NULL AND TRY_CAST("timestamp" AS TIMESTAMP) IS NULL) AS unparseable_timestamp,
  (ingested_at IS NOT NULL AND TRY_CAST(ingested_at AS TIMESTAMP) IS NULL)
    AS unparseable_ingested_at,
  (amount IS NOT NULL AND NOT isnan(amount) AND TRY_CAST(amount AS DECIMAL(18,2)) IS NULL)
    AS amount_overflow,
  COALESCE(amount = 0, FALSE) AS zero_amount,
  COALESCE(amount > 1000000 AND NOT isnan(amount), FALSE) AS amount_over_1m,
  COALESCE(currency NOT IN ('USD', 'EUR', 'GBP', 'JPY', 'CAD', 'AUD', 'CHF'), TRUE)
    AS unsupported_currency,
  COALESCE(status NOT IN ('completed', 'pending', 'failed', 'reversed'), TRUE)
    AS unsupported_status
FROM raw_transactions r"""
MODEL_CTES["flagged"] = """
SELECT *, (null_transaction_id OR null_account_id OR null_amount OR null_currency
           OR null_timestamp OR duplicate_transaction_id OR negative_amount
           OR invalid_transaction_type OR unparseable_timestamp OR unparseable_ingested_at
           OR amount_overflow) AS is_invalid
FROM flags"""
MODEL_CTES["vcounts"] = """
SELECT COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE is_invalid) AS error_count,
  COUNT(*) FILTER (WHERE null_transaction_id) AS null_transaction_id,
  COUNT(*) FILTER (WHERE null_account_id) AS null_account_id,
  COUNT(*) FILTER (WHERE null_amount) AS null_amount,
  COUNT(*) FILTER (WHERE null_currency) AS null_currency,
  COUNT(*) FILTER (WHERE null_timestamp) AS null_timestamp,
  COUNT(*) FILTER (WHERE duplicate_transaction_id) AS duplicate_transaction_id,
  COUNT(*) FILTER (WHERE negative_amount) AS negative_amount,
  COUNT(*) FILTER (WHERE invalid_transaction_type) AS invalid_transaction_type,
  COUNT(*) FILTER (WHERE unparseable_timestamp) AS unparseable_timestamp,
  COUNT(*) FILTER (WHERE unparseable_ingested_at) AS unparseable_ingested_at,
  COUNT(*) FILTER (WHERE amount_overflow) AS amount_overflow,
  COUNT(*) FILTER (WHERE zero_amount) AS zero_amount,
  COUNT(*) FILTER (WHERE amount_over_1m) AS amount_over_1m,
  COUNT(*) FILTER (WHERE unsupported_currency) AS unsupported_currency,
  COUNT(*) FILTER (WHERE unsupported_status) AS unsupported_status
FROM flagged"""
MODEL_CTES["vresult"] = """
SELECT error_count = 0 AS passed, total_rows, total_rows - error_count AS valid_rows,
  error_count,
  CASE WHEN total_rows > 0 THEN CAST(total_rows - error_count AS DOUBLE) / total_rows
       ELSE 0.0 END AS pass_rate,
  concat_ws('|',
    CASE WHEN null_transaction_id > 0 THEN 'Column ''transaction_id'' has ' || null_transaction_id || ' null values' END,
    CASE WHEN null_account_id > 0 THEN 'Column ''account_id'' has ' || null_account_id || ' null values' END,
    CASE WHEN null_amount > 0 THEN 'Column ''amount'' has ' || null_amount || ' null values' END,
    CASE WHEN null_currency > 0 THEN 'Column ''currency'' has ' || null_currency || ' null values' END,
    CASE WHEN null_timestamp > 0 THEN 'Column ''timestamp'' has ' || null_timestamp || ' null values' END,
    CASE WHEN duplicate_transaction_id > 0 THEN 'Found ' || duplicate_transaction_id || ' duplicate transaction_ids' END,
    CASE WHEN negative_amount > 0 THEN negative_amount || ' transactions have negative amounts' END,
    CASE WHEN invalid_transaction_type > 0 THEN invalid_transaction_type || ' rows have invalid transaction_type' END,
    CASE WHEN unparseable_timestamp > 0 THEN unparseable_timestamp || ' rows have unparseable timestamps' END,
    CASE WHEN unparseable_ingested_at > 0 THEN unparseable_ingested_at || ' rows have unparseable ingested_at values' END,
    CASE WHEN amount_overflow > 0 THEN amount_overflow || ' rows have amounts beyond DECIMAL(18,2)' END
  ) AS errors,
  concat_ws('|',
    CASE WHEN zero_amount > 0 THEN zero_amount || ' transactions have zero amount' END,
    CASE WHEN amount_over_1m > 0 THEN amount_over_1m || ' transactions exceed $1M — verify legitimacy' END,
    CASE WHEN unsupported_currency > 0 THEN unsupported_currency || ' rows have unsupported currency codes' END
  ) AS warnings,
  null_transaction_id AS n_null_transaction_id, null_account_id AS n_null_account_id,
  null_amount AS n_null_amount, null_currency AS n_null_currency,
  null_timestamp AS n_null_timestamp, duplicate_transaction_id AS n_duplicate_transaction_id,
  negative_amount AS n_negative_amount, invalid_transaction_type AS n_invalid_transaction_type,
  unparseable_timestamp AS n_unparseable_timestamp,
  unparseable_ingested_at AS n_unparseable_ingested_at, amount_overflow AS n_amount_overflow,
  zero_amount AS n_zero_amount, amount_over_1m AS n_amount_over_1m,
  unsupported_currency AS n_unsupported_currency, unsupported_status AS n_unsupported_status
FROM vcounts"""

# Rates are rounded half up in whole hundredths, without a floating-point tie.
MODEL_CTES["summary"] = """
SELECT * EXCLUDE (done, volume, exposure, dearest, cheapest), done AS completed_count,
  volume::DOUBLE AS total_volume_usd, volume::DOUBLE / transaction_count AS avg_transaction_usd,
  dearest::DOUBLE AS max_transaction_usd, cheapest::DOUBLE AS min_transaction_usd,
  ((done * 20000 + transaction_count) // (2 * transaction_count))::DOUBLE / 100 AS success_rate_pct,
  coalesce(exposure, 0)::DOUBLE AS fraud_exposure_usd
FROM (
  SELECT transaction_date, transaction_hour, region, transaction_type, channel, currency_code,
    count(*) AS transaction_count, len(list_distinct(list(account_id))) AS unique_accounts,
    len(list_distinct(list(merchant_id))) AS unique_merchants,
    sum(amount_usd) AS volume, max(amount_usd) AS dearest, min(amount_usd) AS cheapest,
    count(*) FILTER (transaction_status = 'completed') AS done,
    count(*) FILTER (transaction_status = 'failed') AS failed_count,
    count(*) FILTER (transaction_status = 'pending') AS pending_count,
    count(*) FILTER (is_fraud_flagged) AS fraud_flagged_count,
    count(*) FILTER (aml_flag) AS aml_flagged_count,
    count(*) FILTER (is_large_transaction) AS large_txn_count,
    sum(amount_usd) FILTER (is_fraud_flagged) AS exposure
  FROM enriched GROUP BY ALL)"""

MODEL_CTES["judged_signals"] = """
SELECT *, list_filter([
    if(transaction_id IS NULL, 'null_transaction_id', NULL),
    if(fraud_score IS NULL OR fraud_score = 'NaN', 'null_fraud_score', NULL),
    if(fraud_score <> 'NaN' AND score IS NULL, 'unparseable_fraud_score', NULL),
    if(fraud_score <> 'NaN' AND score NOT BETWEEN 0 AND 1, 'score_out_of_range', NULL),
    if(is_flagged IS NOT NULL AND flag IS NULL, 'unparseable_is_flagged', NULL),
    if(scored_at IS NULL, 'null_scored_at', NULL),
    if(scored_at IS NOT NULL AND moment IS NULL, 'unparseable_scored_at', NULL)],
    lambda x: x IS NOT NULL) AS reasons,
  coalesce(flag <> (score >= 0.75) AND fraud_score <> 'NaN', false) AS flag_disagrees
FROM (SELECT *, try_cast(fraud_score AS DOUBLE) AS score, try_cast(is_flagged AS BOOLEAN) AS flag,
        try_cast(scored_at AS TIMESTAMP) AS moment FROM text_signals)"""

MODEL_CTES["wh_txn"] = """
SELECT transaction_id, account_id, merchant_id, amount_usd, currency_code, transaction_type,
  transaction_status, region, channel, transaction_at, transaction_date,
  COALESCE(is_large_transaction, FALSE) AS is_large_transaction, ingested_at,
  fraud_score, risk_tier, COALESCE(is_fraud_flagged, FALSE) AS is_fraud_flagged,
  COALESCE(requires_review, FALSE) AS requires_review, COALESCE(aml_flag, FALSE) AS aml_flag,
  CAST(NULL AS VARCHAR) AS compliance_notes, CAST(NULL AS VARCHAR) AS reviewed_by,
  CAST(NULL AS TIMESTAMP) AS reviewed_at
FROM enriched"""

RUN_DATE = "2024-01-03"
TIERS_SQL = "('critical', 'high', 'medium', 'low', 'minimal')"
TYPES_SQL = "('debit', 'credit', 'transfer', 'withdrawal', 'deposit')"
STATUS_SQL = "('completed', 'pending', 'failed', 'reversed')"
CURR_SQL = "('USD', 'EUR', 'GBP', 'JPY', 'CAD', 'AUD', 'CHF')"
RAW_COLS = ("transaction_id, account_id, amount, currency, transaction_type, merchant_id, "
            '"timestamp", status, region, channel, ip_address, device_id, ingested_at')

_ORDER = list(RAW_CTES) + list(MODEL_CTES)
_DEPS = {
    "ev": [], "txn_base": ["ev"], "raw_transactions": ["txn_base"], "sig_scores": ["ev"],
    "raw_fraud_signals": ["sig_scores"], "text_signals": ["sig_scores"], "judged_signals": ["text_signals"],
    "tiers": [], "stg_transactions": ["raw_transactions"],
    "stg_fraud_signals": ["raw_fraud_signals", "tiers"], "velocity": ["stg_transactions"],
    "enriched": ["stg_transactions", "stg_fraud_signals"],
    "fraud_mart": ["enriched", "tiers"], "flags": ["raw_transactions"], "flagged": ["flags"],
    "vcounts": ["flagged"], "vresult": ["vcounts"], "wh_txn": ["enriched"], "summary": ["enriched"],
}
_ALL = {**RAW_CTES, **MODEL_CTES}


def with_ctes(needed: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (transitively), in dependency order."""
    extra = extra or {}
    deps = dict(_DEPS)
    deps.update({name: list(needed) for name in extra})
    want: set[str] = set()

    def visit(n):
        if n in want:
            return
        for d in deps.get(n, []):
            visit(d)
        want.add(n)

    for n in list(needed) + list(extra):
        visit(n)
    order = [n for n in _ORDER if n in want] + [n for n in extra]
    parts = [f"{n} AS ({(extra.get(n) or _ALL[n]).strip()})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def dbl(col: str, alias: str | None = None) -> str:
    return f"CAST({col} AS DOUBLE) AS {alias or col.split('.')[-1]}"


def reasons_text(col: str = "fraud_reasons", alias: str = "fraud_reasons") -> str:
    return f"array_to_string({col}, '|') AS {alias}"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["stg_transactions"] = with_ctes(["stg_transactions"], f"""
SELECT transaction_id, account_id, merchant_id, {dbl('amount_usd')}, currency_code,
  transaction_type, transaction_status, region, channel, transaction_at, transaction_date,
  transaction_hour, is_large_transaction, ingested_at
FROM stg_transactions""")
    q["stg_fraud_signals"] = with_ctes(["stg_fraud_signals"], f"""
SELECT transaction_id, {dbl('fraud_score')}, is_flagged, risk_tier, {reasons_text()},
  model_version, scored_at
FROM stg_fraud_signals""")
    q["velocity_hourly"] = with_ctes(["velocity"], f"""
SELECT account_id, transaction_date, transaction_hour, txn_count_1h,
  {dbl('total_amount_1h')}, {dbl('max_amount_1h')}
FROM velocity""")
    q["stream_velocity"] = q["velocity_hourly"] + "\nWHERE transaction_date IS NOT NULL"
    q["txn_enriched"] = with_ctes(["enriched"], f"""
SELECT transaction_id, account_id, merchant_id, {dbl('amount_usd')}, currency_code,
  transaction_type, transaction_status, region, channel, transaction_at, transaction_date,
  transaction_hour, is_large_transaction, {dbl('fraud_score')}, is_fraud_flagged, risk_tier,
  {reasons_text()}, fraud_model_version, txn_count_1h, {dbl('total_amount_1h')},
  requires_review, aml_flag, ingested_at
FROM enriched""")
    q["mart_transaction_summary"] = with_ctes(["summary"], "SELECT * FROM summary")
    q["incremental_refresh"] = q["mart_transaction_summary"]
    q["mart_fraud_detection"] = with_ctes(["fraud_mart"], f"""
SELECT transaction_id, account_id, merchant_id, {dbl('amount_usd')}, currency_code,
  transaction_type, transaction_status, region, channel, transaction_at, transaction_date,
  {dbl('fraud_score')}, risk_tier, {reasons_text()}, fraud_model_version, txn_count_1h,
  requires_review, aml_flag, is_large_transaction, risk_priority, recommended_action
FROM fraud_mart
ORDER BY risk_priority ASC, fraud_score DESC, transaction_id ASC""")
    q["validate_rule_counts"] = with_ctes(["vresult"], "SELECT * FROM vresult")
    q["validate_row_reasons"] = with_ctes(["flagged"], f"""
SELECT {RAW_COLS}, is_invalid,
  concat_ws('|',
    CASE WHEN null_transaction_id THEN 'null_transaction_id' END,
    CASE WHEN null_account_id THEN 'null_account_id' END,
    CASE WHEN null_amount THEN 'null_amount' END,
    CASE WHEN null_currency THEN 'null_currency' END,
    CASE WHEN null_timestamp THEN 'null_timestamp' END,
    CASE WHEN duplicate_transaction_id THEN 'duplicate_transaction_id' END,
    CASE WHEN negative_amount THEN 'negative_amount' END,
    CASE WHEN invalid_transaction_type THEN 'invalid_transaction_type' END,
    CASE WHEN unparseable_timestamp THEN 'unparseable_timestamp' END,
    CASE WHEN unparseable_ingested_at THEN 'unparseable_ingested_at' END,
    CASE WHEN amount_overflow THEN 'amount_overflow' END) AS error_reasons,
  concat_ws('|',
    CASE WHEN zero_amount THEN 'zero_amount' END,
    CASE WHEN amount_over_1m THEN 'amount_over_1m' END,
    CASE WHEN unsupported_currency THEN 'unsupported_currency' END,
    CASE WHEN unsupported_status THEN 'unsupported_status' END) AS warning_reasons
FROM flagged""")
    q["valid_rows"] = with_ctes(["flagged"], f"SELECT {RAW_COLS} FROM flagged WHERE NOT is_invalid")
    q["dead_letter"] = with_ctes(["flagged"], f"""
SELECT {RAW_COLS},
  concat_ws('|',
    CASE WHEN null_transaction_id THEN 'null_transaction_id' END,
    CASE WHEN null_account_id THEN 'null_account_id' END,
    CASE WHEN null_amount THEN 'null_amount' END,
    CASE WHEN null_currency THEN 'null_currency' END,
    CASE WHEN null_timestamp THEN 'null_timestamp' END,
    CASE WHEN duplicate_transaction_id THEN 'duplicate_transaction_id' END,
    CASE WHEN negative_amount THEN 'negative_amount' END,
    CASE WHEN invalid_transaction_type THEN 'invalid_transaction_type' END,
    CASE WHEN unparseable_timestamp THEN 'unparseable_timestamp' END,
    CASE WHEN unparseable_ingested_at THEN 'unparseable_ingested_at' END,
    CASE WHEN amount_overflow THEN 'amount_overflow' END) AS reject_reasons,
  DATE '{RUN_DATE}' AS batch_date
FROM flagged WHERE is_invalid""")
    q["ingest_summary"] = with_ctes(["vresult"], f"""
SELECT 'transactions' AS entity, '{RUN_DATE}' AS partition_date, total_rows AS rows_fetched,
  valid_rows AS rows_valid, error_count AS rows_rejected,
  printf('%.1f%%', pass_rate * 100) AS pass_rate,
  'raw/transactions/year={RUN_DATE[:4]}/month={RUN_DATE[5:7]}/day={RUN_DATE[8:]}' AS lake_path,
  warnings
FROM vresult""")
    q["fraud_ingest_summary"] = with_ctes(["raw_fraud_signals"], f"""
SELECT COUNT(*) AS total_scored, COUNT(*) FILTER (WHERE is_flagged) AS flagged,
  printf('%.1f%%', CAST(COUNT(*) FILTER (WHERE is_flagged) AS DOUBLE) / COUNT(*) * 100) AS flag_rate,
  'raw/fraud_signals/year={RUN_DATE[:4]}/month={RUN_DATE[5:7]}/day={RUN_DATE[8:]}' AS lake_path
FROM raw_fraud_signals""")
    q["signal_dead_letter"] = with_ctes(["judged_signals"], f"""
SELECT transaction_id, fraud_score, is_flagged, '' AS fraud_reasons, model_version, scored_at,
  array_to_string(reasons, '|') AS reject_reasons, DATE '{RUN_DATE}' AS batch_date
FROM judged_signals WHERE len(reasons) > 0""")
    q["valid_signals"] = with_ctes(["judged_signals"], """
SELECT transaction_id, score AS fraud_score, flag AS is_flagged, '' AS fraud_reasons, model_version,
  scored_at
FROM judged_signals WHERE len(reasons) = 0""")
    q["signal_rule_counts"] = with_ctes(["judged_signals"], """
SELECT count(*) AS total_scored, count(*) FILTER (len(reasons) > 0) AS rejected, """ + ", ".join(
        f"count(*) FILTER (list_contains(reasons, '{r}')) AS n_{r}" for r in (
            "null_transaction_id", "null_fraud_score", "unparseable_fraud_score",
            "score_out_of_range", "unparseable_is_flagged", "null_scored_at",
            "unparseable_scored_at")) + """,
  count(*) FILTER (flag_disagrees) AS n_flag_disagrees
FROM judged_signals""")
    q["anomaly_large"] = with_ctes(["raw_transactions"], f"""
SELECT {RAW_COLS} FROM raw_transactions WHERE amount > 1000000 AND NOT isnan(amount)""")
    raw_types = [("transaction_id", "VARCHAR", "string"), ("account_id", "VARCHAR", "string"),
                 ("amount", "DOUBLE", "double"), ("currency", "VARCHAR", "string"),
                 ("transaction_type", "VARCHAR", "string"), ("merchant_id", "VARCHAR", "string"),
                 ("timestamp", "VARCHAR", "string"), ("status", "VARCHAR", "string"),
                 ("region", "VARCHAR", "string"), ("channel", "VARCHAR", "string"),
                 ("ip_address", "VARCHAR", "string"), ("device_id", "VARCHAR", "string"),
                 ("ingested_at", "VARCHAR", "string")]
    q["schema_drift"] = with_ctes(["raw_transactions"], "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, 'ok' AS issue, '{st}' AS expected_type, "
        f"'{st}' AS actual_type, COUNT(*) FILTER (WHERE \"{c}\" IS NOT NULL AND "
        f"TRY_CAST(\"{c}\" AS {dt}) IS NULL) AS bad_values FROM raw_transactions"
        for c, dt, st in raw_types))
    q["fraud_risk_rules"] = with_ctes(["ev", "tiers"], """
SELECT transaction_id, raw_score, fraud_score, is_flagged,
  array_to_string(list_filter([
    CASE WHEN raw_score > 0.5 THEN 'velocity_check_failed' END,
    CASE WHEN raw_score > 0.6 THEN 'unusual_merchant_category' END,
    CASE WHEN raw_score > 0.7 THEN 'geo_anomaly' END,
    CASE WHEN raw_score > 0.8 THEN 'device_fingerprint_mismatch' END,
    CASE WHEN raw_score > 0.9 THEN 'known_fraud_network' END], lambda x: x IS NOT NULL), '|')
    AS fraud_reasons,
  'fraud-v2.3.1' AS model_version,
  tier AS risk_tier
FROM (
  SELECT CAST(k AS VARCHAR) AS transaction_id, u AS raw_score, round(u, 4) AS fraud_score,
         u >= 0.75 AS is_flagged
  FROM (SELECT k, CAST((k * 7919) % 1000003 AS DOUBLE) / 1000003 AS u FROM ev)
) JOIN tiers ON fraud_score::DECIMAL(6,4) >= lowest AND fraud_score::DECIMAL(6,4) < below""")
    q["latest_signal"] = with_ctes(["stg_fraud_signals"], f"""
SELECT transaction_id, {dbl('fraud_score')}, is_flagged, risk_tier, {reasons_text()},
  model_version, scored_at
FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY scored_at DESC,
    fraud_score DESC, is_flagged DESC, risk_tier DESC, fraud_reasons DESC,
    model_version DESC) AS rn
  FROM stg_fraud_signals)
WHERE rn = 1""")
    q["mart_compliance"] = with_ctes(["enriched"], """
SELECT md5(transaction_id || '|' || report_type) AS report_id, report_type, transaction_id,
  account_id, CAST(amount_usd AS DOUBLE) AS amount_usd,
  CASE WHEN report_type = 'CTR' THEN 'amount ' || CAST(amount_usd AS VARCHAR) || ' >= 10000'
       WHEN _flagged THEN 'fraud score flagged'
       WHEN _cnt > 20 THEN 'velocity ' || CAST(_cnt AS VARCHAR) || ' transactions in hour'
       WHEN _total > 50000 THEN 'hourly total ' || CAST(_total AS VARCHAR) || ' > 50000'
       ELSE 'large amount with elevated score' END AS reason,
  'pending' AS status, CAST(NULL AS TIMESTAMP) AS submitted_at
FROM (
  SELECT transaction_id, report_type, max(account_id) AS account_id,
    max(amount_usd) AS amount_usd, bool_or(is_fraud_flagged) AS _flagged,
    max(txn_count_1h) AS _cnt, max(total_amount_1h) AS _total
  FROM (
    SELECT transaction_id, account_id, amount_usd, 'CTR' AS report_type, is_fraud_flagged,
      txn_count_1h, total_amount_1h
    FROM enriched WHERE is_large_transaction
    UNION ALL
    SELECT transaction_id, account_id, amount_usd, 'SAR' AS report_type, is_fraud_flagged,
      txn_count_1h, total_amount_1h
    FROM enriched WHERE requires_review OR COALESCE(total_amount_1h > 50000, FALSE)
  )
  GROUP BY transaction_id, report_type
)""")
    q["warehouse_transactions_v3"] = with_ctes(["wh_txn"], f"""
SELECT transaction_id, account_id, merchant_id, {dbl('amount_usd')}, currency_code,
  transaction_type, transaction_status, region, channel, transaction_at, transaction_date,
  is_large_transaction, ingested_at, {dbl('fraud_score')}, risk_tier, is_fraud_flagged,
  requires_review, aml_flag, compliance_notes, reviewed_by, reviewed_at
FROM wh_txn""")
    q["pk_violations"] = with_ctes(["wh_txn"], """
SELECT transaction_id, COUNT(*) AS row_count FROM wh_txn GROUP BY transaction_id
HAVING COUNT(*) > 1""")
    q["fk_orphans"] = with_ctes(["stg_transactions", "stg_fraud_signals"], f"""
SELECT transaction_id, {dbl('fraud_score')}, is_flagged, risk_tier, {reasons_text()},
  model_version, scored_at
FROM stg_fraud_signals f
WHERE f.transaction_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM stg_transactions t WHERE t.transaction_id = f.transaction_id)""")
    nn_cols = ["transaction_id", "account_id", "amount_usd", "currency_code", "transaction_type",
               "transaction_status", "transaction_at", "transaction_date",
               "is_large_transaction", "ingested_at", "is_fraud_flagged", "requires_review",
               "aml_flag"]
    q["not_null_violations"] = with_ctes(["wh_txn"], "\nUNION ALL\n".join(
        f"SELECT 'transactions' AS model, '{c}' AS column_name, 'not_null' AS test, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS failures FROM wh_txn" for c in nn_cols))
    lengths = {"transaction_id": 36, "account_id": 36, "merchant_id": 36, "currency_code": 3,
               "transaction_type": 20, "transaction_status": 20, "region": 20, "channel": 20,
               "risk_tier": 10, "reviewed_by": 100}
    q["length_violations"] = with_ctes(["wh_txn"], "\nUNION ALL\n".join(
        f"SELECT 'transactions' AS model, '{c}' AS column_name, 'max_length' AS test, "
        f"COUNT(*) FILTER (WHERE length({c}) > {n}) AS failures FROM wh_txn"
        for c, n in lengths.items()))

    def av(model, table, col, values):
        return (f"SELECT '{model}' AS model, '{col}' AS column_name, 'accepted_values' AS test, "
                f"COUNT(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN {values}) AS failures "
                f"FROM {table}")

    def nn(model, table, col):
        return (f"SELECT '{model}' AS model, '{col}' AS column_name, 'not_null' AS test, "
                f"COUNT(*) FILTER (WHERE {col} IS NULL) AS failures FROM {table}")

    def uq(model, table, cols, nonnull):
        where = f"WHERE {cols[0]} IS NOT NULL" if nonnull else ""
        keys = ", ".join(cols)
        return (f"SELECT '{model}' AS model, '{'+'.join(cols)}' AS column_name, 'unique' AS test, "
                f"COUNT(*) AS failures FROM (SELECT {keys} FROM {table} {where} GROUP BY {keys} "
                f"HAVING COUNT(*) > 1)")

    av_parts = [av("stg_transactions", "stg_transactions", "transaction_type", TYPES_SQL),
                av("stg_transactions", "stg_transactions", "transaction_status", STATUS_SQL),
                av("stg_transactions", "stg_transactions", "currency_code", CURR_SQL),
                av("stg_fraud_signals", "stg_fraud_signals", "risk_tier", TIERS_SQL)]
    q["accepted_values"] = with_ctes(["stg_transactions", "stg_fraud_signals"],
                                     "\nUNION ALL\n".join(av_parts))
    report = [
        nn("stg_transactions", "stg_transactions", "transaction_id"),
        nn("stg_transactions", "stg_transactions", "account_id"),
        nn("stg_transactions", "stg_transactions", "amount_usd"),
        nn("stg_transactions", "stg_transactions", "transaction_at"),
        *av_parts[:3],
        nn("stg_fraud_signals", "stg_fraud_signals", "transaction_id"),
        nn("stg_fraud_signals", "stg_fraud_signals", "fraud_score"),
        av_parts[3],
        "SELECT 'stg_fraud_signals' AS model, 'transaction_id' AS column_name, "
        "'relationships' AS test, COUNT(*) AS failures FROM stg_fraud_signals f "
        "WHERE f.transaction_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_transactions t "
        "WHERE t.transaction_id = f.transaction_id)",
        nn("int_transactions_enriched", "enriched", "fraud_score"),
        nn("int_transactions_enriched", "enriched", "risk_tier"),
        uq("int_transactions_enriched", "enriched", ["transaction_id"], True),
        nn("mart_transaction_summary", "summary", "transaction_count"),
        uq("mart_transaction_summary", "summary",
           ["transaction_date", "transaction_hour", "region", "transaction_type", "channel",
            "currency_code"], False),
        nn("mart_fraud_detection", "fraud_mart", "transaction_id"),
        av("mart_fraud_detection", "fraud_mart", "risk_priority", "(1, 2, 3, 4, 5)"),
        av("mart_fraud_detection", "fraud_mart", "recommended_action",
           "('Immediate Action', 'Monitor', 'No Action')"),
        uq("mart_fraud_detection", "fraud_mart", ["transaction_id"], True),
    ]
    q["data_tests_report"] = with_ctes(
        ["fraud_mart", "summary"], f"""
SELECT model, column_name, test, failures,
  CASE WHEN failures = 0 THEN 'pass'
       WHEN model = 'stg_transactions' AND test = 'accepted_values'
            AND column_name IN ('currency_code', 'transaction_status') THEN 'warn'
       ELSE 'fail' END AS status
FROM (
{chr(10).join(['UNION ALL ' + r if i else r for i, r in enumerate(report)])}
)""")
    q["velocity_rolling_1h"] = with_ctes(["stg_transactions"], """
SELECT transaction_id, account_id, transaction_at,
  COUNT(*) OVER w AS txn_count_rolling_1h,
  CAST(SUM(amount_usd) OVER w AS DOUBLE) AS total_amount_rolling_1h
FROM stg_transactions WHERE transaction_at IS NOT NULL
WINDOW w AS (PARTITION BY account_id ORDER BY epoch_us(transaction_at)
             RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW)
UNION ALL
SELECT transaction_id, account_id, transaction_at, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE)
FROM stg_transactions WHERE transaction_at IS NULL""")
    q["warehouse_fraud_signals"] = with_ctes(["stg_fraud_signals"], """
SELECT row_number() OVER (ORDER BY transaction_id::BIGINT % 2, transaction_id, scored_at,
    model_version, fraud_score, is_flagged) AS id, transaction_id, fraud_score::DOUBLE AS fraud_score,
  is_flagged, risk_tier, array_to_string(fraud_reasons, '|') AS fraud_reasons, model_version, scored_at
FROM stg_fraud_signals""")
    q["lake_roundtrip"] = with_ctes(["raw_fraud_signals"], f"""
SELECT format, transaction_id, fraud_score, is_flagged, array_to_string(fraud_reasons, '|')
  AS fraud_reasons, model_version, scored_at, false AS malformed, '{RUN_DATE[:4]}' AS year,
  '{RUN_DATE[5:7]}' AS month, '{RUN_DATE[8:]}' AS day
FROM raw_fraud_signals, (VALUES ('parquet'), ('csv')) AS formats(format)
WHERE transaction_id::BIGINT % 2 = 1""")
    q["schema_drift_files"] = with_ctes(["raw_transactions"], """
SELECT run_date, column_name,
  CASE WHEN batch = 1 AND column_name = 'channel' THEN 'missing'
       WHEN column_name = 'promo_code' THEN 'extra'
       WHEN batch = 3 AND column_name = 'amount' THEN 'type_changed' ELSE 'ok' END AS issue,
  CASE column_name WHEN 'promo_code' THEN NULL WHEN 'amount' THEN 'double' ELSE 'string' END
    AS expected_type,
  CASE WHEN batch = 1 AND column_name = 'channel' THEN NULL
       WHEN batch <> 3 AND column_name = 'amount' THEN 'double' ELSE 'string' END AS landed_type,
  sum(n)::BIGINT AS n_rows,
  sum(if(batch = 3 AND column_name = 'amount', n_bad, 0))::BIGINT AS bad_values
FROM (SELECT transaction_id::BIGINT % 4 AS batch, count(*) AS n,
        count_if(transaction_id::BIGINT % 53 = 0) AS n_bad FROM raw_transactions GROUP BY 1) AS b
JOIN (VALUES (0, '2024-01-01'), (1, '2024-01-02'), (2, '2024-01-02'), (3, '2024-01-03'))
  AS days(batch, run_date) USING (batch)
JOIN (SELECT unnest(['transaction_id', 'account_id', 'amount', 'currency', 'transaction_type',
        'merchant_id', 'timestamp', 'status', 'region', 'channel', 'ip_address', 'device_id',
        'ingested_at', 'promo_code']) AS column_name) AS c
  ON column_name <> 'promo_code' OR batch = 1
GROUP BY ALL""")
    q["fx_normalised"] = with_ctes(["stg_transactions"], """
SELECT transaction_id, t.currency_code, transaction_date, amount_usd::DOUBLE AS amount_usd,
  if(base, 1, rate)::DOUBLE AS fx_rate, if(base, transaction_date, rate_date) AS fx_date,
  round(amount_usd * if(base, 1, rate)::DECIMAL(18,8), 2)::DOUBLE AS amount_usd_converted
FROM (SELECT *, currency_code IS NOT DISTINCT FROM 'USD' AS base FROM stg_transactions) AS t
ASOF LEFT JOIN (
  SELECT ['EUR', 'GBP', 'BRL'][n_nationkey % 3 + 1] AS currency_code,
    DATE '2023-12-25' + n_nationkey AS rate_date, ((100 + n_nationkey) / 100)::DECIMAL(18,8) AS rate
  FROM nation) AS r ON t.currency_code = r.currency_code AND t.transaction_date >= r.rate_date""")
    q["accounts_joined"] = with_ctes(["stg_transactions"], """
SELECT transaction_id, account_id, amount_usd::DOUBLE AS amount_usd, c_mktsegment AS segment,
  c_nationkey AS nation
FROM stg_transactions LEFT JOIN customer
  ON account_id = if(c_custkey = 0, 'ACC_HOT', 'ACC_' || c_custkey)""")
    whole = {"int_transactions_enriched": "txn_enriched", "mart_compliance": "mart_compliance",
             "mart_transaction_summary": "mart_transaction_summary",
             "mart_fraud_detection": "mart_fraud_detection"}
    q["incremental_refresh_all"] = "\nUNION ALL BY NAME\n".join(
        f"SELECT '{table}' AS table_name, * FROM ({q[name]})" for table, name in whole.items())
    q["stream_ingest"] = f"""
SELECT 'raw' AS zone, * FROM ({q['valid_rows']})
UNION ALL BY NAME
SELECT 'dead_letter' AS zone, * EXCLUDE (batch_date) FROM ({q['dead_letter']})"""
    # one run per third of the ids; the last third comes without the amounts
    q["pipeline_audit"] = with_ctes(["flagged", "raw_fraud_signals"], f"""
SELECT 'transaction_pipeline' AS pipeline_name, DATE '{RUN_DATE}' AS partition_date,
  if(run = 2, 'failed', 'success') AS status,
  if(run = 2, 0, count(*) FILTER (NOT is_invalid)) AS rows_ingested,
  if(run = 2, count(*), count(*) FILTER (is_invalid)) AS rows_failed,
  if(run = 2, 'Missing required columns: [''amount'']', NULL) AS error_message,
  any_value(flagged) AS fraud_flagged
FROM (SELECT *, transaction_id::BIGINT % 3 AS run FROM flagged)
JOIN (SELECT transaction_id::BIGINT % 3 AS run, count(*) FILTER (is_flagged) AS flagged
      FROM raw_fraud_signals GROUP BY run) USING (run)
GROUP BY run""")
    return q
