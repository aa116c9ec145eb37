"""Quality rules: deployment bounds, future rows, record gaps and flux limits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.functions.times import MINUTE_US, YEAR_US
from xylemflow.operators.enrich import match_deployments
from xylemflow.operators.timestamps import PREVIOUS_UTC, attach_previous_utc

SUSPECT = "SUSPECT"
SEPARATOR = "|"

# --- Fixed values: reason texts, in reporting order ---------------------------------------
BEFORE_DEPLOYMENT = "timestamp_before_deployment"
BEFORE_FIRST_DEPLOYMENT = "timestamp_before_first_deployment"
AFTER_DEPLOYMENT = "timestamp_after_deployment"
FUTURE = "timestamp_future"
RECORD_GAP = "record_gap_gt_quality_gap_years"
FLUX_ABOVE = "sap_flux_density_above_quality_max_flux_cm_hr"
FLUX_BELOW = "sap_flux_density_below_quality_min_flux_cm_hr"
# --- End of fixed values ------------------------------------------------------------------

START, END = "deployment_start_timestamp_utc", "deployment_end_timestamp_utc"


def earliest_deployments(df: DataFrame) -> DataFrame:
    """First deployment start seen per sensor; one row per sensor after map-side combining."""
    return (
        df.where(F.col(START).isNotNull())
        .groupBy("logger_id", "sdi12_address")
        .agg(F.min(START).alias("_first_start"))
    )


def first_starts(times: DataFrame, deployments: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`earliest_deployments` from thin sensor times alone.

    ``times`` has one row per record and sensor address, so neither the observations nor their
    parameters are computed for it. Each sensor and deployment is one row before the starts are joined.
    """
    met = match_deployments(times, deployments, aliases, "_deployment").where(F.col("_deployment").isNotNull())
    sensors = met.select("logger_id", "sdi12_address", "_deployment").distinct()
    return earliest_deployments(sensors.join(deployments.select(F.col("deployment_id").alias("_deployment"), START), "_deployment"))


def record_gap(df: DataFrame) -> DataFrame:
    """Add boolean ``record_gap``: years since the logger's previous record exceed the limit."""
    source = df if PREVIOUS_UTC in df.columns else attach_previous_utc(df)
    return source.withColumn("record_gap", F.expr(GAP)).drop(PREVIOUS_UTC)


def _us(ts: str) -> str:
    return f"CAST(unix_micros(CAST({ts} AS TIMESTAMP_LTZ)) AS DOUBLE)"


def _minutes(name: str) -> str:
    return f"coalesce({name}, 0D) * {MINUTE_US}D"


def _below(left: str, right: str) -> str:
    """``left < right`` that is false for NaN on either side (Spark sorts NaN last)."""
    return f"({left} < {right} AND NOT isnan({left}) AND NOT isnan({right}))"


GAP = (
    f"coalesce(abs({_us('timestamp_utc')} - {_us(PREVIOUS_UTC)}) / {YEAR_US}D"
    " > coalesce(quality_gap_years, 0D), false)"
)


def apply_quality_filters(
    df: DataFrame, now: datetime, matched_only: bool = False, starts: DataFrame | None = None
) -> DataFrame:
    """Add ``quality`` (``SUSPECT`` or null) and ``quality_explanation`` (reasons joined by ``|``).

    ``now`` is an argument so that a rerun gives the same result. ``matched_only`` says that
    every row has a deployment; the first-deployment rule, which concerns only rows without
    one, then needs no second pass. Neither does it where ``starts`` gives the first start of
    each sensor (see :func:`first_starts`).
    """
    columns = [c for c in df.columns if c != PREVIOUS_UTC]
    source = df if PREVIOUS_UTC in df.columns else attach_previous_utc(df)
    if not matched_only:
        known = earliest_deployments(df) if starts is None else starts
        source = source.join(known, ["logger_id", "sdi12_address"], "left")

    moment = f"TIMESTAMP_NTZ'{now:%Y-%m-%d %H:%M:%S.%f}'"
    times = source.withColumns(
        {
            "_ts": F.expr(_us("timestamp_utc")),
            "_begin": F.expr(f"{_us(START)} - {_minutes('quality_deployment_start_grace_minutes')}"),
            "_finish": F.expr(
                f"{_us(f'coalesce({END}, {moment})')} + {_minutes('quality_deployment_end_grace_minutes')}"
            ),
        }
    )
    flux, upper, lower = (
        "sap_flux_density_j_dma_cm_hr",
        "quality_max_flux_cm_hr",
        "quality_min_flux_cm_hr",
    )
    rules = {
        BEFORE_DEPLOYMENT: _below("_ts", "_begin"),
        BEFORE_FIRST_DEPLOYMENT: None
        if matched_only
        else f"{START} IS NULL AND "
        + _below("_ts", f"({_us('_first_start')} - {_minutes('quality_deployment_start_grace_minutes')})"),
        AFTER_DEPLOYMENT: "_ts > _finish",
        FUTURE: f"_ts > {_us(moment)} + {_minutes('quality_future_lead_minutes')}",
        RECORD_GAP: GAP,
        FLUX_ABOVE: _below(upper, flux),
        FLUX_BELOW: _below(flux, lower),
    }
    reasons = ", ".join(
        f"CASE WHEN {rule} THEN '{reason}' END" for reason, rule in rules.items() if rule
    )
    explained = times.withColumn(
        "quality_explanation", F.expr(f"nullif(concat_ws('{SEPARATOR}', {reasons}), '')")
    )
    return explained.select(
        *columns,
        F.expr(f"CASE WHEN quality_explanation IS NOT NULL THEN '{SUSPECT}' END AS quality"),
        "quality_explanation",
    )
