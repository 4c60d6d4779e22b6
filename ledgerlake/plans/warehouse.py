"""Loads of warehouse tables with a surrogate key."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ledgerlake.operators.evolve import warehouse_fraud_signals
from ledgerlake.plans.commit import BATCH, BatchRun


def fraud_signals_path(root: str) -> str:
    return f"{root.rstrip('/')}/warehouse/fraud_signals"


def load_fraud_signals(run: BatchRun, stg_fraud: DataFrame, now: Column | None = None) -> None:
    """Stage a batch's scores as rows of the warehouse table; ids go on from the stored maximum,
    which is committed with the rows. A load that failed leaves no gap and no id twice."""
    sequence = f"{run.root}/warehouse/_sequence/fraud_signals.json"
    last = json.loads(run.store.read_text(sequence) or '{"last": 0}')["last"]
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    rows = warehouse_fraud_signals(stg_fraud, now, last + 1, run.stage)
    run.stage(rows.observe(seen, F.count(F.lit(1)).alias("n")), "warehouse_fraud_signals")
    run.add_file_set("warehouse_fraud_signals", f"{fraud_signals_path(run.root)}/{BATCH}={run.batch_id}")
    run.store.write_text(f"{run.work}/fraud_signals.json", json.dumps({"last": last + seen.get["n"]}))
    run.add_file_set("fraud_signals.json", sequence)
