"""Projection of a model output onto the form the DuckDB oracle also produces.

Only the *presentation* changes: per-query current-timestamp columns are dropped, decimals
are shown as DOUBLE (exact decimal arithmetic happens before this cast) and string arrays
as ``|``-joined text. The models themselves keep their SQL types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

NOW_COLUMNS = {"model_updated_at", "mart_updated_at", "created_at", "updated_at"}


def comparable(df: DataFrame, keep_now: bool = False) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in NOW_COLUMNS and not keep_now:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, "|")
        cols.append(c.alias(f.name))
    return df.select(*cols)
