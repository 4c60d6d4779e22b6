"""Command line: ``spark-submit -m ledgerlake ...`` or ``python -m ledgerlake ...``.

    run          validate + land one batch, incremental refresh, data tests, audit row
    full-refresh rebuild every table from all landed raw data
    data-tests   run the data tests over the written models

The session comes from ``SparkSession.builder.getOrCreate()`` (the cluster's settings);
only one-row results and the small test report are printed.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from ledgerlake.plans.refresh import full_refresh, run_data_tests, run_pipeline
from ledgerlake.schemas import RAW_FRAUD_SIGNALS, RAW_TRANSACTIONS
from ledgerlake.session import BASE_CONF, ensure_checkpoint_dir
from ledgerlake.sources.lake import read_zone


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("ledgerlake").getOrCreate()
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, BASE_CONF[k])
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="ingest one batch and refresh incrementally")
    run.add_argument("--root", required=True, help="lake root (shared filesystem)")
    run.add_argument("--transactions", required=True, help="landed transaction batch (parquet)")
    run.add_argument("--signals", required=True, help="landed fraud-signal batch (parquet)")
    run.add_argument("--date", default=None, help="partition (run) date, default today UTC")
    full = sub.add_parser("full-refresh", help="rebuild all tables from the raw zone")
    full.add_argument("--root", required=True)
    tests = sub.add_parser("data-tests", help="run data tests over the written models")
    tests.add_argument("--root", required=True)
    args = ap.parse_args(argv)

    spark = _session()
    if args.cmd == "run":
        raw_t = spark.read.schema(RAW_TRANSACTIONS).parquet(args.transactions)
        raw_f = spark.read.schema(RAW_FRAUD_SIGNALS).parquet(args.signals)
        row = run_pipeline(spark, raw_t, raw_f, args.root, args.date).collect()[0]
        print(json.dumps(row.asDict(), default=str))
    elif args.cmd == "full-refresh":
        raw_t = read_zone(spark, args.root, "transactions", RAW_TRANSACTIONS)
        raw_f = read_zone(spark, args.root, "fraud_signals", RAW_FRAUD_SIGNALS)
        full_refresh(spark, raw_t.select(*RAW_TRANSACTIONS.fieldNames()),
                     raw_f.select(*RAW_FRAUD_SIGNALS.fieldNames()), args.root)
        print(json.dumps({"full_refresh": "done", "root": args.root}))
    else:
        for r in run_data_tests(spark, args.root).collect():   # one row per test
            print(json.dumps(r.asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
