"""Catalog materialisation: staging as temporary views, intermediate and marts as tables.

Tables are external (``USING parquet LOCATION``) over the folders the refresh drivers write,
in databases whose own locations sit under the lake root, so nothing lands in a local
warehouse folder. Date partitions are discovered with ``RECOVER PARTITIONS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.plans.refresh import path_exists, table_paths

LAYERS = {
    "intermediate": ["int_transactions_enriched"],
    "marts": ["mart_transaction_summary", "mart_fraud_detection", "mart_compliance"],
}


def register_staging_views(stg_t: DataFrame, stg_f: DataFrame) -> None:
    stg_t.createOrReplaceTempView("stg_transactions")
    stg_f.createOrReplaceTempView("stg_fraud_signals")


def register_models(spark: SparkSession, root: str) -> list[str]:
    """Create (or refresh) ``intermediate.*`` and ``marts.*`` tables over ``root``."""
    paths = table_paths(root)
    names = []
    for db, tables in LAYERS.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root.rstrip('/')}/_catalog/{db}'")
        for t in tables:
            if not path_exists(spark, paths[t]):
                continue
            schema = spark.read.parquet(paths[t]).schema
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
                             if f.name != "transaction_date")
            spark.sql(f"DROP TABLE IF EXISTS {db}.{t}")
            spark.sql(f"CREATE TABLE {db}.{t} ({cols}, transaction_date date) USING parquet "
                      f"PARTITIONED BY (transaction_date) LOCATION '{paths[t]}'")
            spark.sql(f"ALTER TABLE {db}.{t} RECOVER PARTITIONS")
            names.append(f"{db}.{t}")
    return names
