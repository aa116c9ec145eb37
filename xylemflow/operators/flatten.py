"""Nested parsed files to flat observations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.schema import METRIC_COLUMNS, OBSERVATION_SCHEMA


def flatten_parsed_files(files: DataFrame) -> DataFrame:
    """One observation per logger row and (address, depth) slot of each file.

    ``files`` has ``file_hash``, ``logger_id``, ``rows`` (array of struct with the logger
    values and the array ``cells`` of all readings) and ``slots`` (array of struct
    ``sdi12_address, thermistor_depth, cells`` with the cell index of each canonical metric,
    null where the file has none). Two narrow explodes; nothing is shuffled.
    """
    rows = files.select("file_hash", "logger_id", "slots", F.explode("rows").alias("row"))
    pairs = rows.select("file_hash", "logger_id", "row", F.explode("slots").alias("slot"))
    return pairs.select(
        "row.timestamp",
        "row.record",
        "row.battery_voltage_v",
        "row.panel_temperature_c",
        "logger_id",
        "file_hash",
        "slot.sdi12_address",
        "slot.thermistor_depth",
        *[
            F.get(F.col("row.cells"), F.col("slot.cells")[i]).alias(name)
            for i, name in enumerate(METRIC_COLUMNS)
        ],
    )


def to_canonical(df: DataFrame) -> DataFrame:
    """Order the canonical columns and pad missing ones with nulls of the right type."""
    known = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in OBSERVATION_SCHEMA.fields
        ]
    )


def stack(*frames: DataFrame) -> DataFrame:
    """Vertical stack of frames with equal columns; a different column set is an error."""
    first = frames[0]
    for number, frame in enumerate(frames[1:], start=2):
        if set(frame.columns) != set(first.columns):
            odd = sorted(set(frame.columns) ^ set(first.columns))
            raise ValueError(f"frame {number} differs from the first in columns {odd}")
    return reduce(lambda left, right: left.unionByName(right), frames)


def drop_copies(observations: DataFrame) -> DataFrame:
    """Keep one copy of each (logger, record, address, depth), from the smallest file hash."""
    keys = ["logger_id", "record", "sdi12_address", "thermistor_depth"]
    rest = [c for c in observations.columns if c not in keys]
    ordered = F.struct(F.col("file_hash").alias("_first"), *[F.col(c) for c in rest])
    chosen = observations.groupBy(*keys).agg(F.min(ordered).alias("_row"))
    return chosen.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}") for c in observations.columns]
    )


