"""True UTC time for observations, from the deployment active at each download chunk.

Records seen in the same set of files form a chunk. A chunk takes one UTC offset: that of the
site whose deployment was active when its lowest record was written.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xylemflow.functions.ordered import previous_value
from xylemflow.functions.times import (
    local_to_utc_offset,
    shift_seconds,
    utc_to_local,
    within,
)

NO_ACTIVE_DEPLOYMENT = "no_active_deployment"
SIGNATURE_SEPARATOR = "+"
PREVIOUS_UTC = "_previous_utc"
ROWS = "_rows"
ADDRESSES = "_addresses"


class CorrectedTime(NamedTuple):
    observations: DataFrame
    skipped_chunks: DataFrame


def _required(name: str) -> Column:
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"observation without {name}")))


def record_map(observations: DataFrame, with_head: bool = False, with_addresses: bool = False) -> DataFrame:
    """One row per (logger, record): earliest timestamp and the sorted set of its files.

    A plain aggregate, so copies of a hot record are combined before the shuffle. ``with_head``
    also keeps the first row's rank and the number of rows, ``with_addresses`` the set of sensor
    addresses that the record holds values of.
    """
    keyed = observations.select(
        _required("logger_id").alias("logger_id"),
        _required("record").alias("record"),
        _required("timestamp").alias("timestamp"),
        F.coalesce("file_hash", F.lit("")).alias("file_hash"),
        *(["sdi12_address", "thermistor_depth"] if with_head else ["sdi12_address"] if with_addresses else []),
    )
    files = F.array_sort(F.collect_set("file_hash"))
    measures = [
        F.min("timestamp").alias("timestamp"),
        F.array_join(files, SIGNATURE_SEPARATOR).alias("file_set_signature"),
    ]
    if with_head:
        measures += [F.min(row_rank()).alias("_head"), F.count(F.lit(1)).alias(ROWS)]
    if with_addresses:
        measures.append(F.collect_set("sdi12_address").alias(ADDRESSES))
    # The number comes first: sorts compare it by prefix before they look at the text.
    return keyed.groupBy("record", "logger_id").agg(*measures)


def row_rank() -> Column:
    """Order of the rows that share a logger and record."""
    return F.struct("sdi12_address", "thermistor_depth", F.coalesce("file_hash", F.lit("")).alias("file_hash"))


def chunk_anchors(records: DataFrame) -> DataFrame:
    """Per (logger, signature): number of records and the timestamp of the lowest one."""
    return records.groupBy("logger_id", "file_set_signature").agg(
        F.min_by("timestamp", "record").alias("anchor_timestamp"),
        F.count(F.lit(1)).alias("row_count"),
    )


def local_deployments(deployments: DataFrame, sites: DataFrame) -> DataFrame:
    """Deployment bounds in the wall-clock time of their site; an unknown site is an error."""
    missing = F.raise_error(F.concat(F.lit("site not found: "), F.coalesce(F.col("site_id").cast("string"), F.lit("null"))))
    zoned = deployments.join(sites.select("site_id", "timezone"), "site_id", "left").withColumn(
        "timezone", F.coalesce("timezone", missing)
    )
    return zoned.select(
        "datalogger_id",
        "site_id",
        "deployment_id",
        utc_to_local(F.col("timezone"), F.col("deployment_start_timestamp_utc")).alias(
            "start_timestamp_local"
        ),
        utc_to_local(F.col("timezone"), F.col("deployment_end_timestamp_utc")).alias(
            "end_timestamp_local"
        ),
    )


def chunk_offsets(
    anchors: DataFrame,
    sites: DataFrame,
    deployments: DataFrame,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """Attach site, zone and UTC offset to each chunk; null offset means no active deployment.

    The first matching deployment counts, in order of local start and then id. With
    ``aliases`` given, chunks that carry a logger alias are also matched; by default they
    are not, and are reported as skipped.
    """
    named = deployments.select(
        F.col("datalogger_id").alias("logger_id"),
        "site_id",
        "start_timestamp_local",
        "end_timestamp_local",
        "deployment_id",
        F.lit(0).alias("_via"),
    )
    if aliases is not None:
        renamed = aliases.select(F.col("alias").alias("logger_id"), "datalogger_id").distinct()
        named = named.unionByName(
            deployments.join(renamed, "datalogger_id").select(
                "logger_id",
                "site_id",
                "start_timestamp_local",
                "end_timestamp_local",
                "deployment_id",
                F.lit(1).alias("_via"),
            )
        )
    zoned = named.join(sites.select("site_id", "timezone"), "site_id", "left")
    a, d = anchors.alias("a"), zoned.alias("d")
    active = (F.col("a.logger_id") == F.col("d.logger_id")) & within(
        F.col("a.anchor_timestamp"),
        F.col("d.start_timestamp_local"),
        F.col("d.end_timestamp_local"),
    )
    matched = a.join(d, active, "left").select(
        "a.*",
        F.when(
            F.col("d.logger_id").isNotNull(),
            F.struct("d._via", "d.start_timestamp_local", "d.deployment_id", "d.site_id", "d.timezone"),
        ).alias("_match"),
    )
    first = matched.groupBy("logger_id", "file_set_signature", "anchor_timestamp", "row_count").agg(
        F.min("_match").alias("_match")
    )
    zone = F.coalesce(
        F.col("_match.timezone"),
        F.raise_error(F.concat(F.lit("site not found: "), F.col("_match.site_id").cast("string"))),
    )
    offset = local_to_utc_offset(zone, F.col("anchor_timestamp"))
    return first.select(
        "logger_id",
        "file_set_signature",
        "anchor_timestamp",
        "row_count",
        F.col("_match.site_id").alias("site_id"),
        F.col("_match.timezone").alias("timezone"),
        F.when(F.col("_match").isNotNull(), offset).alias("utc_offset_seconds"),
    )


def skipped_chunks(offsets: DataFrame) -> DataFrame:
    """Report of chunks without an active deployment."""
    return offsets.where(F.col("utc_offset_seconds").isNull()).select(
        "logger_id",
        "file_set_signature",
        F.date_format("anchor_timestamp", "yyyy-MM-dd HH:mm:ss").alias("anchor_timestamp_local"),
        "row_count",
        F.lit(NO_ACTIVE_DEPLOYMENT).alias("reason"),
    )


def utc_records(records: DataFrame, offsets: DataFrame) -> DataFrame:
    """The record map with UTC time, without the records of skipped chunks."""
    known = offsets.where(F.col("utc_offset_seconds").isNotNull()).select(
        "logger_id", "file_set_signature", "utc_offset_seconds"
    )
    return records.join(known, ["logger_id", "file_set_signature"]).select(
        *[F.col(c) for c in records.columns],
        shift_seconds(F.col("timestamp"), -F.col("utc_offset_seconds")).alias("timestamp_utc"),
    )


def sensor_times(records: DataFrame, offsets: DataFrame) -> DataFrame:
    """``logger_id, sdi12_address, timestamp_utc`` of a record map that holds addresses."""
    return utc_records(records, offsets).select("logger_id", F.explode(ADDRESSES).alias("sdi12_address"), "timestamp_utc")


def timed_rows(records: DataFrame, offsets: DataFrame) -> DataFrame:
    """One row: how many observations have a UTC time, summed over the thin record map."""
    counted = records.groupBy("logger_id", "file_set_signature").agg(F.sum(ROWS).alias(ROWS))
    known = offsets.where(F.col("utc_offset_seconds").isNotNull()).select("logger_id", "file_set_signature")
    return counted.join(known, ["logger_id", "file_set_signature"]).agg(F.coalesce(F.sum(ROWS), F.lit(0)).alias("timed_rows"))


def correct_timestamps(
    observations: DataFrame,
    sites: DataFrame,
    deployments: DataFrame,
    aliases: DataFrame | None = None,
    with_previous: bool = False,
) -> CorrectedTime:
    """Attach ``file_set_signature``, ``timestamp_utc`` and the raw local time.

    ``deployments`` carries local bounds (see :func:`local_deployments`). Every copy of a
    record is kept and takes the same UTC time; records of skipped chunks are dropped.
    ``with_previous`` also leaves the UTC time of the logger's previous record on the first
    row of each record, which the quality rules use for record gaps.
    """
    records = record_map(observations, with_head=with_previous)
    offsets = chunk_offsets(chunk_anchors(records), sites, deployments, aliases)
    return CorrectedTime(
        attach_utc(observations, records, offsets, with_previous), skipped_chunks(offsets)
    )


def attach_utc(
    observations: DataFrame, records: DataFrame, offsets: DataFrame, with_previous: bool = False
) -> DataFrame:
    """Join the observations to the UTC time and signature of their record."""
    known = utc_records(records, offsets).drop("timestamp", ROWS, ADDRESSES)
    if with_previous:
        known = previous_value(
            known, ["logger_id"], F.col("record"), ["record"], "timestamp_utc", PREVIOUS_UTC
        )
    # The join keys depend on the check, so that it fires even where the other side is empty.
    missing = F.raise_error(F.lit("observation without record"))
    checked = observations.withColumn("record", F.coalesce("record", missing.cast(observations.schema["record"].dataType)))
    joined = checked.join(known, ["record", "logger_id"])
    if with_previous:
        joined = joined.withColumn(
            PREVIOUS_UTC, F.when(row_rank() == F.col("_head"), F.col(PREVIOUS_UTC))
        ).drop("_head")
    corrected = joined.withColumn("raw_local_timestamp_often_wrong", F.col("timestamp"))
    tail = ["file_set_signature", "timestamp_utc", "raw_local_timestamp_often_wrong"]
    extra = [PREVIOUS_UTC] if with_previous else []
    return corrected.select(*observations.columns, *tail, *extra)


def gap_points(df: DataFrame) -> DataFrame:
    """Distinct (logger, record, UTC time) points with the first row of each and the time before.

    Copies are combined before the shuffle, so a record held by many rows stays one point.
    """
    points = (
        df.where(
            F.col("logger_id").isNotNull()
            & F.col("record").isNotNull()
            & F.col("timestamp_utc").isNotNull()
        )
        .groupBy("logger_id", "record", "timestamp_utc")
        .agg(F.min(row_rank()).alias("_head"))
    )
    return previous_value(
        points,
        ["logger_id"],
        F.col("record"),
        ["record", "timestamp_utc"],
        "timestamp_utc",
        PREVIOUS_UTC,
    )


def attach_previous_utc(df: DataFrame) -> DataFrame:
    """Leave the previous record's UTC time on the first row of each record; null elsewhere."""
    columns = df.columns
    source = df if "file_hash" in columns else df.withColumn("file_hash", F.lit(None).cast("string"))
    if "thermistor_depth" not in columns:
        source = source.withColumn("thermistor_depth", F.lit(None).cast("string"))
    joined = source.join(gap_points(source), ["logger_id", "record", "timestamp_utc"], "left")
    return joined.select(
        *[F.col(c) for c in columns],
        F.when(row_rank().eqNullSafe(F.col("_head")), F.col(PREVIOUS_UTC)).alias(PREVIOUS_UTC),
    )
