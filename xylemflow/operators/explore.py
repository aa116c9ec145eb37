"""Read path over a finished table: filters, statistics, down-sampling, labels, QC panels."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xylemflow.functions.ordered import global_index, previous_value
from xylemflow.functions.text import clean, deployment_title, panel_title, slug
from xylemflow.functions.times import micros

MAX_POINTS = 120_000

# --- Fixed values: columns of the explorer ------------------------------------------------
PLOT_COLUMNS = [
    "timestamp",
    "sap_flux_density_j_dma_cm_hr",
    "quality",
    "plant_code",
    "stem_code",
    "species_scientific_name",
    "thermistor_depth",
    "deployment_id",
    "file_set_signature",
]
STEM_COLUMNS = [
    "project_name",
    "project_code",
    "site_name",
    "zone_name",
    "plot_name",
    "sdi12_address",
    "plant_code",
    "species_scientific_name",
    "stem_code",
    "deployment_id",
]
STEM_FILTERS = ["deployment_id", "plant_code", "stem_code", "sdi12_address"]
# --- End of fixed values ------------------------------------------------------------------

FILE_ORDER = ["timestamp", "logger_id", "record", "sdi12_address", "thermistor_depth", "file_hash"]


@dataclass(frozen=True)
class Selection:
    """What the explorer shows; unset criteria do not filter."""

    stem: dict[str, str | None] | None = None
    depths: Sequence[str | None] = ()
    start: datetime | None = None
    end: datetime | None = None
    include_suspect: bool = True


def filtered(df: DataFrame, selection: Selection) -> DataFrame:
    """Apply a selection as plain predicates, which reach the Parquet scan."""
    result = df
    for name in STEM_FILTERS:
        value = (selection.stem or {}).get(name)
        if value is not None:
            result = result.where(F.col(name) == value)
    if selection.depths:
        named = [d for d in selection.depths if d is not None]
        keep = F.col("thermistor_depth").isin(*named) if named else F.lit(False)
        if len(named) < len(selection.depths):
            keep |= F.col("thermistor_depth").isNull()
        result = result.where(keep)
    if selection.start is not None:
        result = result.where(F.col("timestamp") >= F.lit(selection.start))
    if selection.end is not None:
        result = result.where(F.col("timestamp") <= F.lit(selection.end))
    if not selection.include_suspect and "quality" in df.columns:
        result = result.where(F.col("quality").isNull())
    return result


def statistics(df: DataFrame) -> DataFrame:
    """Rows, suspect rows and time span in one aggregate; absent columns give 0 or null."""
    suspect = F.count("quality") if "quality" in df.columns else F.lit(0).cast("bigint")
    absent = F.lit(None).cast("timestamp_ntz")
    has_time = "timestamp" in df.columns
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        suspect.alias("suspect_rows"),
        (F.min("timestamp") if has_time else absent).alias("min_timestamp"),
        (F.max("timestamp") if has_time else absent).alias("max_timestamp"),
    )


def projected(df: DataFrame) -> DataFrame:
    return df.select([c for c in PLOT_COLUMNS if c in df.columns])


def downsampled(
    df: DataFrame, max_points: int = MAX_POINTS, order: Sequence[str] = FILE_ORDER, with_index: bool = True
) -> DataFrame:
    """Every n-th row in file order, only if there are more rows than points.

    The result carries ``row_nr``. The row index is global but computed in parallel. Without
    ``with_index``, a frame that needs no sampling comes back as it is, neither sorted nor staged.
    """
    total = df.count()
    if total <= max_points and not with_index:
        return df
    keys = [c for c in order if c in df.columns]
    indexed = global_index(df, keys)
    if total <= max_points:
        return indexed
    return indexed.where(F.col("row_nr") % math.ceil(total / max_points) == 0)


class Exploration(NamedTuple):
    points: DataFrame
    statistics: DataFrame


def explore(df: DataFrame, selection: Selection, max_points: int = MAX_POINTS) -> Exploration:
    """Filter, statistics, down-sampling, projection and time order of one explorer request."""
    chosen = filtered(df, selection)
    keys = [c for c in FILE_ORDER if c in df.columns]
    narrow = chosen.select(*dict.fromkeys([c for c in PLOT_COLUMNS if c in df.columns] + keys))
    points = projected(downsampled(narrow, max_points, with_index=False)).orderBy("timestamp")
    return Exploration(points, statistics(chosen))


def depth_options(df: DataFrame) -> DataFrame:
    """Distinct depths, nulls first, with their label."""
    return (
        df.select("thermistor_depth")
        .distinct()
        .select(
            F.coalesce("thermistor_depth", F.lit("Unknown depth")).alias("label"),
            F.col("thermistor_depth").alias("value"),
        )
        .orderBy(F.asc_nulls_first("value"))
    )


def stem_options(df: DataFrame) -> DataFrame:
    """Distinct stems with their three label lines, in the order of the drop-down."""
    present = [c for c in STEM_COLUMNS if c in df.columns]
    stems = df.select(*present).distinct()

    def value(name: str) -> Column:
        return F.col(name) if name in present else F.lit(None).cast("string")

    project = clean(value("project_name"), "Project ?")
    code = clean(value("project_code"), "")
    labelled = F.when(
        (code != "") & (F.lower(code) != F.lower(project)) & (F.lower(code) != "project ?"),
        F.concat(project, F.lit(" ("), code, F.lit(")")),
    ).otherwise(project)
    deployment = clean(value("deployment_id"), "?")
    lines = [
        F.concat(labelled, F.lit(" | "), clean(value("species_scientific_name"), "Species ?")),
        F.concat(
            F.lit("Site "), clean(value("site_name"), "Site ?"),
            F.lit(" | Zone "), clean(value("zone_name"), "?"),
            F.lit(" | Plot "), clean(value("plot_name"), "?"),
        ),
        F.concat(
            F.lit("SDI "), clean(value("sdi12_address"), "?"),
            F.lit(" | Plant "), clean(value("plant_code"), "?"),
            F.lit(" | Stem "), clean(value("stem_code"), "?"),
            F.lit(" | Dep "), F.substring(deployment, 1, 6),
        ),
    ]
    named = F.coalesce(F.nullif(value("project_name"), F.lit("")), value("project_code"))
    order = [
        F.lower(clean(named, "Project ?")),
        F.lower(clean(value("site_name"), "Site ?")),
        F.lower(clean(value("plant_code"), "Plant ?")),
        F.lower(clean(value("stem_code"), "Stem ?")),
        F.lower(clean(value("deployment_id"), "Deployment ?")),
    ]
    return stems.select(
        *present,
        F.array(*lines).alias("lines"),
        F.concat_ws(" | ", *lines).alias("label"),
        F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)]).alias("_order"),
    ).orderBy("_order").drop("_order")


def chunk_boundaries(df: DataFrame) -> DataFrame:
    """Per deployment, the times at which the file set changes; the first chunk is not marked.

    Rows are combined to distinct (deployment, time, signature) before the ordered pass, which
    cuts each deployment into time buckets. Deployments without any signature give nothing.
    """
    points = (
        df.where(F.col("timestamp").isNotNull())
        .groupBy("deployment_id", "timestamp", "file_set_signature")
        .agg(F.min("record").alias("record"))
    )
    lagged = previous_value(
        points.withColumn("_signature", F.struct("file_set_signature")),
        ["deployment_id"],
        micros(F.col("timestamp")),
        ["timestamp", "record", "file_set_signature"],
        "_signature",
        "_previous",
        bucket_bits=36,
        null_keys=True,
    )
    return lagged.where(
        F.col("_previous").isNotNull()
        & ~F.col("_previous.file_set_signature").eqNullSafe(F.col("file_set_signature"))
    ).select("deployment_id", F.col("timestamp").alias("boundary"))


def qc_rows(df: DataFrame, exclude_suspect: bool = False) -> DataFrame:
    """Rows for QC plots: flag column, optional exclusion, missing descriptive columns filled."""
    flagged = df.withColumn("quality_flagged", F.col("quality").isNotNull())
    if exclude_suspect:
        flagged = flagged.where(~F.col("quality_flagged"))
    for name in ("file_set_signature", "plant_code", "stem_code"):
        if name not in flagged.columns:
            flagged = flagged.withColumn(name, F.lit(None).cast("string"))
    if "species_scientific_name" not in flagged.columns:
        fallback = F.col("species_code") if "species_code" in flagged.columns else F.lit("Species ?")
        flagged = flagged.withColumn("species_scientific_name", fallback)
    return flagged


def qc_panels(df: DataFrame) -> DataFrame:
    """One row per deployment and panel: title, rows, flagged rows and time span."""
    return (
        df.groupBy("deployment_id", "plant_code", "stem_code", "species_scientific_name")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if("quality_flagged").alias("flagged_rows"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
        )
        .withColumn(
            "title",
            panel_title(F.col("plant_code"), F.col("stem_code"), F.col("species_scientific_name")),
        )
    )


def deployment_titles(df: DataFrame) -> DataFrame:
    """Title and file slug per deployment, from the first non-null value of each part in time."""
    parts = [c for c in ("site_name", "zone_name", "plot_name", "datalogger_id") if c in df.columns]
    order = F.struct(*[F.col(c) for c in FILE_ORDER if c in df.columns])
    firsts = df.groupBy("deployment_id").agg(
        *[
            F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c)
            for c in parts
        ]
    )

    def part(name: str) -> Column:
        return F.trim(F.col(name)) if name in parts else F.lit(None).cast("string")

    title = deployment_title(
        part("site_name"), part("zone_name"), part("plot_name"), part("datalogger_id"),
        F.trim(F.col("deployment_id")),
    )
    return firsts.select("deployment_id", title.alias("title"), slug(title).alias("slug"))
