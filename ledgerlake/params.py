"""Pipeline parameters, passed explicitly to every model."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # These must equal the reference's settings and model literals.
    large_txn_threshold: int = 10000          # inclusive, on the decimal amount
    fraud_score_threshold: float = 0.75       # inclusive, on the unrounded score
    velocity_spike_count: int = 20            # exclusive (> 20 per account-hour)
    large_review_score: float = 0.4           # exclusive (> 0.4 with a large amount)
    aml_hourly_total: int = 50000             # exclusive (> 50000 per account-hour)
    anomaly_amount: int = 1_000_000           # exclusive (> 1,000,000 is a warning)
    lookback_days: int = 30                   # optional event-date window (off by default)
    schedule_minutes: int = 15                # micro-batch interval
    batch_size: int = 5000                    # records per source call (not a row cap here)
    raw_zone: str = "raw"
    processed_zone: str = "processed"
    serving_zone: str = "serving"

    # Our own choices (not from the reference).
    apply_lookback: bool = False
    signal_dedup: str = "none"                # "none" keeps the fan-out; "latest" keeps one signal per id
    fraud_reasons_separator: str = "|"
    # Skew handling: a join key with more rows than this is split over ceil(n / hot_key_rows)
    # partitions; the broadcast list of such keys has at most (rows / hot_key_rows) entries.
    hot_key_rows: int | None = 1_000_000
    # Folders that the index of transaction ids is dealt to; fixed for the life of a lake. A
    # batch opens those of its own ids, so a large lake wants thousands.
    index_buckets: int = 16


DEFAULT = Params()
