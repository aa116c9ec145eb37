"""Orphaned objects: stored keys that no registry row refers to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.functions.text import CARTRIDGE_PREFIX, OUTPUT_PREFIX, RAW_PREFIX, raw_file_key


def referenced_keys(raw_files: DataFrame, outputs: DataFrame) -> DataFrame:
    """Every object key the registries refer to."""
    return (
        raw_files.select(raw_file_key(F.col("file_hash")).alias("object_key"))
        .unionByName(outputs.select(F.col("object_store_path").alias("object_key")))
        .unionByName(outputs.select(F.col("reproducibility_cartridge_path").alias("object_key")))
        .where(F.col("object_key").isNotNull())
    )


def orphaned_keys(listing: DataFrame, raw_files: DataFrame, outputs: DataFrame) -> DataFrame:
    """``prefix, object_key`` of listed keys under the three prefixes without a reference."""
    key = F.col("object_key")
    prefix = (
        F.when(key.startswith(RAW_PREFIX), RAW_PREFIX)
        .when(key.startswith(OUTPUT_PREFIX), OUTPUT_PREFIX)
        .when(key.startswith(CARTRIDGE_PREFIX), CARTRIDGE_PREFIX)
    )
    known = listing.select(prefix.alias("prefix"), "object_key").where(F.col("prefix").isNotNull())
    return known.join(referenced_keys(raw_files, outputs), "object_key", "left_anti").select(
        "prefix", "object_key"
    )
