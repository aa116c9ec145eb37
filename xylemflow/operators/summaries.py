"""Receipt summaries over a finished observation table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.functions.times import rfc3339_micros
from xylemflow.operators.quality import SUSPECT

TOP_REASONS = 5
TOP_OVERRIDES = 3
SOURCE_PREFIX = "parameter_source_"


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row frames as one row; they meet on a constant key."""
    joined = rows[0].withColumn("_one", F.lit(1))
    for row in rows[1:]:
        joined = joined.join(row.withColumn("_one", F.lit(1)), "_one")
    return joined.drop("_one")


def split_by_deployment(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a deployment, one-row count of the others)."""
    kept = df.where(F.col("deployment_id").isNotNull())
    excluded = df.agg(
        F.count_if(F.col("deployment_id").isNull()).alias("excluded_rows_no_deployment")
    )
    return kept, excluded


def quality_summary(df: DataFrame) -> DataFrame:
    """Total, suspect and good rows and the suspect ratio (0.0 on an empty table)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("quality") == SUSPECT).alias("suspect_rows"),
    )
    return counts.select(
        "total_rows",
        "suspect_rows",
        (F.col("total_rows") - F.col("suspect_rows")).alias("good_rows"),
        F.coalesce(F.try_divide(F.col("suspect_rows").cast("double"), F.col("total_rows")), F.lit(0.0)).alias(
            "suspect_ratio"
        ),
    )


def quality_reasons(df: DataFrame) -> DataFrame:
    """Rows per quality reason.

    Explanations are counted before they are split, so the explode sees only the few
    distinct combinations.
    """
    combinations = (
        df.where(F.col("quality_explanation").isNotNull())
        .groupBy("quality_explanation")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    reasons = combinations.select(
        F.explode(F.split("quality_explanation", r"\|")).alias("reason"), "_rows"
    )
    return (
        reasons.where(F.col("reason") != "")
        .groupBy("reason")
        .agg(F.sum("_rows").alias("count"))
    )


def top_quality_reasons(df: DataFrame, limit: int = TOP_REASONS) -> DataFrame:
    """The most frequent reasons, ties by name."""
    return quality_reasons(df).orderBy(F.desc("count"), "reason").limit(limit)


def provenance_summary(df: DataFrame, limit: int = TOP_OVERRIDES) -> DataFrame:
    """Per parameter its most frequent override source; then the parameters with most rows.

    The combinations of sources are counted first (one shuffle of few groups), then
    unpivoted.
    """
    sources = [c for c in df.columns if c.startswith(SOURCE_PREFIX)]
    combinations = df.groupBy(*sources).agg(F.count(F.lit(1)).alias("_rows"))
    long = combinations.unpivot(["_rows"], sources, "_column", "source")
    counted = (
        long.where(
            F.col("source").isNotNull()
            & (F.col("source") != "")
            & ~F.col("source").contains("default")
            & (F.lower("source") != "default")
        )
        .groupBy(
            F.expr(f"substring(_column, {len(SOURCE_PREFIX) + 1})").alias("parameter"), "source"
        )
        .agg(F.sum("_rows").alias("count"))
    )
    leading = counted.groupBy("parameter").agg(
        F.min(F.struct((-F.col("count")).alias("_less"), "source", "count")).alias("_first")
    )
    return (
        leading.select("parameter", "_first.source", "_first.count")
        .orderBy(F.desc("count"), "parameter")
        .limit(limit)
    )


def record_summary(df: DataFrame) -> DataFrame:
    """Distinct loggers, distinct complete sensors, and the covered UTC time.

    Two levels of plain grouping instead of ``count_distinct``: the first combines map-side
    to one row per sensor.
    """
    sensors = df.groupBy("logger_id", "sdi12_address", "thermistor_depth").agg(
        F.min("timestamp_utc").alias("_start"), F.max("timestamp_utc").alias("_end")
    )
    loggers = sensors.groupBy("logger_id").agg(
        F.count_if(
            F.col("logger_id").isNotNull()
            & F.col("sdi12_address").isNotNull()
            & F.col("thermistor_depth").isNotNull()
        ).alias("_sensors"),
        F.min("_start").alias("_start"),
        F.max("_end").alias("_end"),
    )
    return loggers.agg(
        F.count("logger_id").alias("logger_count"),
        F.coalesce(F.sum("_sensors"), F.lit(0)).alias("sensor_count"),
        rfc3339_micros(F.min("_start")).alias("timeframe_start"),
        rfc3339_micros(F.max("_end")).alias("timeframe_end"),
    )


def ingestion_summary(reports: DataFrame) -> DataFrame:
    """File counts by status."""
    status = F.col("status")
    return reports.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == "Parsed").alias("parsed"),
        F.count_if(status == "Duplicate").alias("duplicates"),
        F.count_if(status == "Failed").alias("failed"),
    )


def latest_flag(outputs: DataFrame) -> DataFrame:
    """Mark the most recently published output; ties go to the larger id.

    The newest row comes from an aggregate, not from a window over the whole registry.
    """
    newest = outputs.agg(F.max(F.struct("published_at", "output_id")).alias("_newest"))
    marked = outputs.drop("is_latest").join(
        newest,
        F.struct("published_at", "output_id") == F.col("_newest"),
        "left",
    )
    return marked.withColumn("is_latest", F.col("_newest").isNotNull()).drop("_newest")

