"""

Every query reads the shared test tables (the raw transaction and fraud-signal feeds are
derived from ``events`` by ``ledgerlake.sources.fixtures``) and runs a model or operator of
the ``ledgerlake`` package over the whole input. Results pass through
``ledgerlake.plans.compare.comparable`` (decimals as DOUBLE, arrays as ``|`` text, per-query
current timestamps dropped) so they line up with the DuckDB twins in ``ledgerlake.oracle``.
"""

from __future__ import annotations

import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlake.constants import TRANSACTIONS_LENGTHS
from ledgerlake.functions.risk import risk_tier, signal_columns
from ledgerlake.operators.constraints import (
    fk_orphans, length_violations, not_null_violations, pk_violations,
)
from ledgerlake.operators.dimensions import normalise_to_usd, with_accounts
from ledgerlake.operators.drift import schema_drift_files
from ledgerlake.operators.evolve import table_schema, warehouse_transactions
from ledgerlake.operators.signals import (
    flag_signals, signal_dead_letter, signal_rule_counts, valid_signals,
)
from ledgerlake.operators.validate import (
    anomaly_rows, dead_letter, flag_rows, fraud_ingest_summary, ingest_summary, row_reasons,
    schema_drift, validation_result, valid_rows,
)
from ledgerlake.operators.velocity import hourly_velocity, rolling_velocity_1h
from ledgerlake.oracle import oracle_sql as _oracle_sql
from ledgerlake.plans.commit import BatchRun
from ledgerlake.plans.compare import comparable
from ledgerlake.plans.data_tests import accepted_values_tests, data_tests_report
from ledgerlake.plans.enriched import latest_signal, transactions_enriched
from ledgerlake.plans.marts import (
    mart_compliance, mart_fraud_detection, mart_transaction_summary,
)
from ledgerlake.plans.refresh import incremental_refresh, run_pipeline, table_paths
from ledgerlake.plans.staging import stg_fraud_signals, stg_transactions
from ledgerlake.plans.warehouse import fraud_signals_path, load_fraud_signals
from ledgerlake.schemas import RAW_FRAUD_SIGNALS, RAW_TRANSACTIONS
from ledgerlake.session import ensure_checkpoint_dir, shared_path
from ledgerlake.sources.fixtures import (
    accounts_from_customer, fx_rates_from_nation, raw_inputs, read_table, text_signals_from_events,
)
from ledgerlake.sources.lake import read_csv_zone, read_zone, upload_dataframe, zone_path
from ledgerlake.streaming.microbatch import apply_batch, ingest_tick, stream_identity
from ledgerlake.streaming.velocity import read_velocity_log, run_velocity_stream

SMOKE_DIR = "/root/testdata/sf0.001"
RUN_DATE = "2024-01-03"  # partition (run) date used by the ingest-style queries


# Logical plans are built once per (session, folder) and shared by the queries: a DataFrame
# is an immutable lazy plan (no data), and current_timestamp() is evaluated per execution.
_PLANS: dict = {}


def _memo(kind: str, spark: SparkSession, sf_dir: str, build):
    key = (kind, id(spark), sf_dir)
    hit = _PLANS.get(key)
    if hit is None or hit[0] is not spark:
        hit = (spark, build())
        _PLANS[key] = hit
    return hit[1]


def _raw(spark: SparkSession, sf_dir: str):
    return _memo("raw", spark, sf_dir, lambda: raw_inputs(spark, sf_dir))


def _staged(spark: SparkSession, sf_dir: str):
    def build():
        raw_t, raw_f = _raw(spark, sf_dir)
        return stg_transactions(raw_t), stg_fraud_signals(raw_f)
    return _memo("staged", spark, sf_dir, build)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        t, f = _staged(spark, sf_dir)
        return transactions_enriched(t, f)
    return _memo("enriched", spark, sf_dir, build)


def q_stg_transactions(spark, sf_dir):
    return comparable(_staged(spark, sf_dir)[0])


def q_stg_fraud_signals(spark, sf_dir):
    return comparable(_staged(spark, sf_dir)[1])


def q_velocity_hourly(spark, sf_dir):
    return comparable(hourly_velocity(_staged(spark, sf_dir)[0]))


def q_txn_enriched(spark, sf_dir):
    return comparable(_enriched(spark, sf_dir))


def q_mart_transaction_summary(spark, sf_dir):
    return comparable(mart_transaction_summary(_enriched(spark, sf_dir)))


def q_mart_fraud_detection(spark, sf_dir):
    return comparable(mart_fraud_detection(_enriched(spark, sf_dir)))


def _raw_txn(spark, sf_dir):
    return _raw(spark, sf_dir)[0]


def q_validate_rule_counts(spark, sf_dir):
    return comparable(validation_result(_raw_txn(spark, sf_dir)))


def q_valid_rows(spark, sf_dir):
    return comparable(valid_rows(flag_rows(_raw_txn(spark, sf_dir))))


def q_validate_row_reasons(spark, sf_dir):
    return comparable(row_reasons(flag_rows(_raw_txn(spark, sf_dir))))


def q_dead_letter(spark, sf_dir):
    return comparable(dead_letter(flag_rows(_raw_txn(spark, sf_dir)),
                                  F.lit(RUN_DATE).cast("date")))


def q_ingest_summary(spark, sf_dir):
    res = validation_result(_raw_txn(spark, sf_dir))
    return comparable(ingest_summary(res, RUN_DATE, zone_path("raw", "transactions", RUN_DATE)))


def q_fraud_ingest_summary(spark, sf_dir):
    raw_f = _raw(spark, sf_dir)[1]
    return comparable(fraud_ingest_summary(raw_f, zone_path("raw", "fraud_signals", RUN_DATE)))


def q_schema_drift(spark, sf_dir):
    """The landed feed checked against the expected raw schema, value by value."""
    return comparable(schema_drift(_raw_txn(spark, sf_dir), RAW_TRANSACTIONS))


def q_anomaly_large(spark, sf_dir):
    return comparable(anomaly_rows(_raw_txn(spark, sf_dir)))


def q_fraud_risk_rules(spark, sf_dir):
    """The scorer's rules (round to 4 dp, flag and reasons on the unrounded score, tier on
    the stored score) over an unrounded score derived from each event id."""
    ev = read_table(spark, sf_dir, "events").select("event_id")
    u = F.pmod(F.col("event_id") * 7919, F.lit(1000003)).cast("double") / 1000003
    scored = ev.select(F.col("event_id").cast("string").alias("transaction_id"),
                       u.alias("raw_score"), *signal_columns(u))
    return comparable(scored.withColumn(
        "risk_tier", risk_tier(F.col("fraud_score").cast("decimal(6,4)"))))


def q_latest_signal(spark, sf_dir):
    return comparable(latest_signal(_staged(spark, sf_dir)[1]))


def q_mart_compliance(spark, sf_dir):
    return comparable(mart_compliance(_enriched(spark, sf_dir)))


def q_warehouse_transactions_v3(spark, sf_dir):
    return comparable(warehouse_transactions(_enriched(spark, sf_dir), 3))


def q_pk_violations(spark, sf_dir):
    return comparable(pk_violations(warehouse_transactions(_enriched(spark, sf_dir), 3),
                                    ["transaction_id"]))


def q_fk_orphans(spark, sf_dir):
    t, f = _staged(spark, sf_dir)
    return comparable(fk_orphans(f, t, "transaction_id", "transaction_id"))


def q_not_null_violations(spark, sf_dir):
    return comparable(not_null_violations(
        warehouse_transactions(_enriched(spark, sf_dir), 3), "transactions", 3))


def q_length_violations(spark, sf_dir):
    return comparable(length_violations(
        warehouse_transactions(_enriched(spark, sf_dir), 3), "transactions",
        TRANSACTIONS_LENGTHS))


def q_accepted_values(spark, sf_dir):
    t, f = _staged(spark, sf_dir)
    return comparable(accepted_values_tests(t, f))


def q_data_tests_report(spark, sf_dir):
    """Data tests over the materialised models: staging and the enriched model are
    checkpointed once (reliable checkpoint in the session's shared folder) and every test
    and mart reads them instead of recomputing the DAG."""
    ensure_checkpoint_dir(spark)
    t, f = (d.checkpoint() for d in _staged(spark, sf_dir))
    e = transactions_enriched(t, f).checkpoint()
    return comparable(data_tests_report(t, f, e, mart_transaction_summary(e),
                                        mart_fraud_detection(e, ordered=False)))


def q_velocity_rolling_1h(spark, sf_dir):
    return comparable(rolling_velocity_1h(_staged(spark, sf_dir)[0]))


def _refreshed_in_batches(spark, sf_dir) -> str:
    """A lake under the session's shared folder, refreshed by three landed batches: transactions
    by ``id % 3``, their scores one batch later."""
    raw_t, raw_f = _raw(spark, sf_dir)
    root = shared_path(spark, "ledgerlake-incremental", uuid.uuid4().hex)
    tid = F.col("transaction_id").cast("long")
    for b in range(3):
        incremental_refresh(spark, raw_t.filter(F.pmod(tid, F.lit(3)) == b),
                            raw_f.filter(F.pmod(tid + 1, F.lit(3)) == b), root)
    return root


def _read_back(spark, root: str, name: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(table_paths(root)[name]).select(*like.columns)


def q_incremental_refresh(spark, sf_dir):
    """The summary mart after three incremental batches must equal the full refresh."""
    root = _refreshed_in_batches(spark, sf_dir)
    like = mart_transaction_summary(_enriched(spark, sf_dir))
    return comparable(_read_back(spark, root, "mart_transaction_summary", like))


def q_incremental_refresh_all(spark, sf_dir):
    """All four written models after three incremental batches, each equal to its full twin."""
    root, enriched = _refreshed_in_batches(spark, sf_dir), _enriched(spark, sf_dir)
    out = None
    for name, like in {
            "int_transactions_enriched": enriched, "mart_compliance": mart_compliance(enriched),
            "mart_transaction_summary": mart_transaction_summary(enriched),
            "mart_fraud_detection": mart_fraud_detection(enriched)}.items():
        rows = comparable(_read_back(spark, root, name, like)) \
            .select(F.lit(name).alias("table_name"), "*")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def _land_by_id(raw: DataFrame, landing: str, files: int = 3) -> None:
    """One landed file for each remainder of the id. The rows are made by all tasks and dealt to
    one that only writes."""
    for b in range(files):
        raw.filter(F.pmod(F.col("transaction_id").cast("long"), F.lit(files)) == b) \
            .repartition(1).write.mode("append").parquet(landing)


def q_stream_ingest(spark, sf_dir):
    """Transactions and scores ingested by micro-batches of one landed file, after which every
    micro-batch of transactions is offered again on another date: the raw zone and the dead letter
    hold each row once."""
    raw_t, raw_f = _raw(spark, sf_dir)
    base = shared_path(spark, "ledgerlake-ingest", uuid.uuid4().hex)
    _land_by_id(raw_t, f"{base}/landing/t")
    _land_by_id(raw_f, f"{base}/landing/f")
    ingest_tick(spark, f"{base}/landing/t", f"{base}/landing/f", f"{base}/lake", f"{base}/checkpoint",
                max_files_per_trigger=1)
    stream = stream_identity(spark, f"{base}/checkpoint/transactions")
    for b in range(3):
        apply_batch(spark, f"{base}/lake", f"txn-{stream}-{b}", transactions=raw_t,
                    run_date="2024-01-09")
    fields = RAW_TRANSACTIONS.fieldNames()
    raw = read_zone(spark, f"{base}/lake", "transactions", RAW_TRANSACTIONS).select(
        F.lit("raw").alias("zone"), *fields)
    dead = read_zone(spark, f"{base}/lake", "transactions_dead_letter", T.StructType(
        RAW_TRANSACTIONS.fields + [T.StructField("reject_reasons", T.ArrayType(T.StringType()))])) \
        .select(F.lit("dead_letter").alias("zone"), *fields, "reject_reasons")
    return comparable(raw.unionByName(dead, allowMissingColumns=True))


def _flagged_text_signals(spark, sf_dir):
    feed = text_signals_from_events(read_table(spark, sf_dir, "events"))
    return flag_signals(feed, F.lit(RUN_DATE).cast("date"))


def q_signal_dead_letter(spark, sf_dir):
    return comparable(signal_dead_letter(_flagged_text_signals(spark, sf_dir))
                      .withColumn("fraud_reasons", F.lit("")))


def q_valid_signals(spark, sf_dir):
    return comparable(valid_signals(_flagged_text_signals(spark, sf_dir))
                      .withColumn("fraud_reasons", F.lit("")))


def q_signal_rule_counts(spark, sf_dir):
    return comparable(signal_rule_counts(_flagged_text_signals(spark, sf_dir)))


def q_pipeline_audit(spark, sf_dir):
    """The run audit of three batches by ``id % 3``; the last comes without the amounts."""
    raw_t, raw_f = _raw(spark, sf_dir)
    root = shared_path(spark, "ledgerlake-audit", uuid.uuid4().hex)
    third = F.pmod(F.col("transaction_id").cast("long"), F.lit(3))
    out = None
    for b in range(3):
        batch = raw_t.filter(third == b)
        row = run_pipeline(spark, batch.drop("amount") if b == 2 else batch,
                           raw_f.filter(third == b), root, RUN_DATE)
        out = row if out is None else out.unionByName(row)
    return comparable(out.select("pipeline_name", "partition_date", "status", "rows_ingested",
                                 "rows_failed", "error_message", "fraud_flagged"))


def _land_by_day(spark, df: DataFrame, landing: str) -> None:
    """Land a feed as one file per event day, oldest first (files arrive in time order)."""
    day = F.substring("timestamp", 1, 10)
    days = sorted(r[0] for r in df.select(day.alias("d")).distinct().collect() if r[0])
    for d in days:
        df.filter(day == d).coalesce(1).write.mode("append").parquet(landing)
    rest = df.filter(day.isNull())
    rest.coalesce(1).write.mode("append").parquet(landing)


def q_stream_velocity(spark, sf_dir):
    """Hourly velocity computed by a watermarked streaming aggregation over the landed
    transaction files (one micro-batch per file), read back from its update log."""
    base = shared_path(spark, "ledgerlake-stream", uuid.uuid4().hex)
    _land_by_day(spark, _raw_txn(spark, sf_dir), f"{base}/landing")
    sid = run_velocity_stream(spark, f"{base}/landing", f"{base}/log", f"{base}/checkpoint",
                              watermark="2 hours", max_files_per_trigger=1)
    return comparable(read_velocity_log(spark, f"{base}/log", sid))


def q_warehouse_fraud_signals(spark, sf_dir):
    """The warehouse's signal table loaded by two runs (scores of even and of odd transactions):
    dense ids that go on from the stored maximum."""
    stg_f = _staged(spark, sf_dir)[1]
    root = shared_path(spark, "ledgerlake-warehouse", uuid.uuid4().hex)
    odd = F.pmod(F.col("transaction_id").cast("long"), F.lit(2))
    for b in range(2):
        run = BatchRun(spark, root, f"load-{b}")
        load_fraud_signals(run, stg_f.filter(odd == b))
        run.commit()
    schema = table_schema("fraud_signals")
    return comparable(spark.read.schema(schema).parquet(fraud_signals_path(root))
                      .select(*schema.fieldNames()))


def q_lake_roundtrip(spark, sf_dir):
    """Scores landed on two dates as Parquet and as CSV, and one date read back from each."""
    raw_f = _raw(spark, sf_dir)[1]
    root = shared_path(spark, "ledgerlake-roundtrip", uuid.uuid4().hex)
    odd = F.pmod(F.col("transaction_id").cast("long"), F.lit(2))
    for b, day in enumerate(("2024-01-02", RUN_DATE)):
        for kind in ("parquet", "csv"):
            upload_dataframe(raw_f.filter(odd == b), root, f"fraud_signals_{kind}", "raw", day, kind)
    fields = RAW_FRAUD_SIGNALS.fieldNames()
    parquet = read_zone(spark, root, "fraud_signals_parquet", RAW_FRAUD_SIGNALS, partition_date=RUN_DATE)
    csv = read_csv_zone(spark, root, "fraud_signals_csv", RAW_FRAUD_SIGNALS, dates=(RUN_DATE, RUN_DATE))
    out = parquet.select(F.lit("parquet").alias("format"), *fields, F.lit(False).alias("malformed"),
                         "year", "month", "day")
    return comparable(out.unionByName(csv.select(
        F.lit("csv").alias("format"), *fields, F.col("_malformed").isNotNull().alias("malformed"),
        "year", "month", "day")))


def q_schema_drift_files(spark, sf_dir):
    """Drift of landed files, from their footers. Four batches by ``id % 4``: the first and the
    third as declared, the second (same day as the third) without ``channel`` and with a column
    more, the fourth with amounts as text, some of which are no numbers."""
    raw_t = _raw_txn(spark, sf_dir)
    root = shared_path(spark, "ledgerlake-drift", uuid.uuid4().hex)
    k = F.col("transaction_id").cast("long")
    text = F.when(F.pmod(k, F.lit(53)) == 0, F.lit("n/a")).otherwise(F.col("amount").cast("string"))
    shapes = [("2024-01-01", lambda df: df),
              ("2024-01-02", lambda df: df.drop("channel").withColumn("promo_code", F.lit("NEW"))),
              ("2024-01-02", lambda df: df),
              (RUN_DATE, lambda df: df.withColumn("amount", text))]
    for b, (day, shape) in enumerate(shapes):
        upload_dataframe(shape(raw_t.filter(F.pmod(k, F.lit(4)) == b)), root, "transactions", "raw", day)
    out = schema_drift_files(spark, f"{root}/{zone_path('raw', 'transactions')}", RAW_TRANSACTIONS)
    return comparable(out.drop("n_files"))  # Spark decides how many files a batch has


def q_fx_normalised(spark, sf_dir):
    """Amounts in USD by the last rate known on the day; the rates, with gaps, are made by rule
    from ``nation``."""
    rates = fx_rates_from_nation(read_table(spark, sf_dir, "nation", spread=False))
    out = normalise_to_usd(_staged(spark, sf_dir)[0], rates)
    return comparable(out.select("transaction_id", "currency_code", "transaction_date", "amount_usd",
                                 "fx_rate", "fx_date", "amount_usd_converted"))


def q_accounts_joined(spark, sf_dir):
    """Transactions with the latest attributes of their accounts, which are made from ``customer``."""
    accounts = accounts_from_customer(read_table(spark, sf_dir, "customer"))
    out = with_accounts(_staged(spark, sf_dir)[0], accounts, ["segment", "nation"], "version")
    return comparable(out.select("transaction_id", "account_id", "amount_usd", "segment", "nation"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the hourly KPI mart over the sf0.001 tables."""
    return q_mart_transaction_summary(spark, SMOKE_DIR)


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, where their files are there."""
    found, sql = {}, {}
    if importlib.util.find_spec("ledgerlake.llm") is not None:
        from ledgerlake.llm.queries import ORACLE_SQL, QUERIES
        found, sql = dict(QUERIES), dict(ORACLE_SQL)
        if importlib.util.find_spec("corpus_pipeline") is not None:
            import corpus_pipeline
            found["pipeline"] = corpus_pipeline.run
            if corpus_pipeline.ORACLE_SQL:
                sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _training_data()[0] | {
        "stg_transactions": q_stg_transactions,
        "stg_fraud_signals": q_stg_fraud_signals,
        "velocity_hourly": q_velocity_hourly,
        "txn_enriched": q_txn_enriched,
        "mart_transaction_summary": q_mart_transaction_summary,
        "mart_fraud_detection": q_mart_fraud_detection,
        "validate_rule_counts": q_validate_rule_counts,
        "validate_row_reasons": q_validate_row_reasons,
        "valid_rows": q_valid_rows,
        "dead_letter": q_dead_letter,
        "ingest_summary": q_ingest_summary,
        "fraud_ingest_summary": q_fraud_ingest_summary,
        "anomaly_large": q_anomaly_large,
        "schema_drift": q_schema_drift,
        "fraud_risk_rules": q_fraud_risk_rules,
        "latest_signal": q_latest_signal,
        "mart_compliance": q_mart_compliance,
        "warehouse_transactions_v3": q_warehouse_transactions_v3,
        "pk_violations": q_pk_violations,
        "fk_orphans": q_fk_orphans,
        "not_null_violations": q_not_null_violations,
        "length_violations": q_length_violations,
        "accepted_values": q_accepted_values,
        "data_tests_report": q_data_tests_report,
        "velocity_rolling_1h": q_velocity_rolling_1h,
        "incremental_refresh": q_incremental_refresh,
        "incremental_refresh_all": q_incremental_refresh_all,
        "stream_ingest": q_stream_ingest,
        "signal_dead_letter": q_signal_dead_letter,
        "valid_signals": q_valid_signals,
        "signal_rule_counts": q_signal_rule_counts,
        "pipeline_audit": q_pipeline_audit,
        "warehouse_fraud_signals": q_warehouse_fraud_signals,
        "lake_roundtrip": q_lake_roundtrip,
        "schema_drift_files": q_schema_drift_files,
        "fx_normalised": q_fx_normalised,
        "accounts_joined": q_accounts_joined,
        "stream_velocity": q_stream_velocity,
    }


def oracle_sql() -> dict[str, str]:
    sql = _oracle_sql() | _training_data()[1]
    return {k: v for k, v in sql.items() if k in queries()}
