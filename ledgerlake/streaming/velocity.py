"""Streaming hourly velocity with a watermark, and streaming de-duplication.

The stream groups staged transactions by (1-hour event-time window, account): the same
buckets as the batch ``hourly_velocity`` (date + hour of the window start). Output mode is
``update``: every micro-batch emits the windows it changed with their running totals, and
``foreachBatch`` writes them to an update log partitioned by batch id (a retried batch
overwrites its own folder). Reading the log keeps, per key, the row of the latest batch - a
grouped ``max`` over a struct, reduced map-side. State is bounded by the watermark; rows
older than the watermark are dropped by Spark, which the batch model never does, so the
watermark must cover the feed's disorder for the two to agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.params import DEFAULT, Params
from ledgerlake.plans.staging import stg_transactions
from ledgerlake.schemas import RAW_TRANSACTIONS
from ledgerlake.streaming.microbatch import stream_identity

KEYS = ["account_id", "transaction_date", "transaction_hour"]


def velocity_stream(raw_stream: DataFrame, watermark: str = "2 hours",
                    dedup: bool = False, params: Params = DEFAULT) -> DataFrame:
    stg = stg_transactions(raw_stream, params, F.lit(None).cast("timestamp")) \
        .filter(F.col("transaction_at").isNotNull()) \
        .withWatermark("transaction_at", watermark)
    if dedup:
        # Optional: drop a re-sent transaction id within the watermark (the batch model
        # keeps duplicates, so this changes counts when the feed repeats ids).
        stg = stg.dropDuplicatesWithinWatermark(["transaction_id"])
    agg = stg.groupBy(F.window("transaction_at", "1 hour").alias("w"), "account_id").agg(
        F.count(F.lit(1)).alias("txn_count_1h"),
        F.sum("amount_usd").alias("total_amount_1h"),
        F.max("amount_usd").alias("max_amount_1h"),
    )
    return agg.select(
        "account_id",
        F.to_date(F.col("w.start")).alias("transaction_date"),
        F.hour(F.col("w.start")).alias("transaction_hour"),
        "txn_count_1h", "total_amount_1h", "max_amount_1h",
    )


def run_velocity_stream(spark: SparkSession, landing: str, log_path: str, checkpoint: str,
                        watermark: str = "2 hours", max_files_per_trigger: int | None = None,
                        dedup: bool = False, params: Params = DEFAULT) -> str:
    """Drain the landed files through the streaming aggregation; returns the stream's
    persistent id. The log is partitioned by stream id and batch number: a restart from the
    same checkpoint continues its stream, a new checkpoint starts a new one, and batch
    numbers of different streams never overwrite each other."""
    reader = spark.readStream.schema(RAW_TRANSACTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = velocity_stream(reader.parquet(landing), watermark, dedup, params)

    def write_updates(batch: DataFrame, batch_id: int) -> None:
        sid = stream_identity(spark, checkpoint)
        (batch.withColumns({"_stream": F.lit(sid), "_batch": F.lit(batch_id)})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_stream", "_batch").parquet(log_path))

    q = (stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(write_updates).trigger(availableNow=True).start())
    q.awaitTermination()
    return str(q.id)


def read_velocity_log(spark: SparkSession, log_path: str, stream_id: str | None = None) -> DataFrame:
    """Current velocity per key for one stream: the latest batch's row for each key.
    Without ``stream_id`` the log must hold a single stream."""
    log = spark.read.parquet(log_path)
    if stream_id is None:
        ids = [r[0] for r in log.select("_stream").distinct().limit(2).collect()]
        if len(ids) > 1:
            raise ValueError("velocity log holds several streams; pass stream_id")
    else:
        log = log.filter(F.col("_stream") == stream_id)
    vals = ["txn_count_1h", "total_amount_1h", "max_amount_1h"]
    best = log.groupBy(*KEYS).agg(F.max(F.struct("_batch", *vals)).alias("b"))
    return best.select(*KEYS, *[F.col(f"b.{c}").alias(c) for c in vals])
