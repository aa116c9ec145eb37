"""Column profile of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_profile(df: DataFrame) -> DataFrame:
    """Rows, nulls, null rate, minimum and maximum (as text) of every column, in one scan."""
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(df.columns):
        measures += [
            F.count_if(F.col(name).isNull()).alias(f"n{i}"),
            F.min(name).cast("string").alias(f"a{i}"),
            F.max(name).cast("string").alias(f"z{i}"),
        ]
    wide = df.agg(*measures)
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("row_count"),
            F.col(f"n{i}").alias("null_count"),
            F.try_divide(F.col(f"n{i}").cast("double"), F.col("_rows")).alias("null_rate"),
            F.col(f"a{i}").alias("min_value"),
            F.col(f"z{i}").alias("max_value"),
        )
        for i, name in enumerate(df.columns)
    ]
    return wide.select(F.inline(F.array(*entries)))
