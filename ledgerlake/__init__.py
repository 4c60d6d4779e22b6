"""ledgerlake: a Spark-native transaction analytics pipeline.

Every model is a plain function from DataFrames to a DataFrame built from
Spark's own column expressions; Catalyst and AQE choose the physical plan.

Sub-packages:
    functions  - column-expression builders (cleaning, risk rules, flags)
    sources    - lake reads/writes, the raw fixture mapping from the test tables
    operators  - validation, velocity, joins, constraints, schema evolution
    plans      - the model DAG (staging, enriched, marts) and refresh drivers
    streaming  - micro-batch ingest and streaming velocity
"""

from ledgerlake.params import Params

__all__ = ["Params"]
