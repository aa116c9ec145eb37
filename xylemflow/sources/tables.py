"""Parquet, registry and receipt readers, and the writers of a run."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xylemflow.functions.text import raw_file_key
from xylemflow.operators.summaries import latest_flag
from xylemflow.session import checkpoint_dir


def scan_observations(spark: SparkSession, path: str) -> DataFrame:
    """An observation or output table; filters and columns are pushed into the scan."""
    return spark.read.parquet(path)


def latest_parquet(spark: SparkSession, folder: str) -> str:
    """Path of the most recently modified Parquet file in a folder."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .select("path", "modificationTime")
    )
    newest = newest_file(listing).first()
    if newest is None or newest.path is None:
        raise FileNotFoundError(f"no parquet file in {folder}")
    return newest.path


def newest_file(listing: DataFrame) -> DataFrame:
    """The row with the latest modification time; ties go to the larger path."""
    return listing.agg(
        F.max(F.struct("modificationTime", "path")).alias("_newest")
    ).select(F.col("_newest.path").alias("path"), F.col("_newest.modificationTime").alias("modificationTime"))


def scan_receipts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Receipt JSON documents to one row per file entry."""
    schema = (
        "receipt struct<files: array<struct<path: string, status: string, parser_attempts: "
        "array<struct<parser: string, message: string, line_index: int>>>>>"
    )
    documents = spark.read.schema(schema).json(
        paths if isinstance(paths, str) else list(paths), multiLine=True
    )
    return documents.select(F.inline("receipt.files"))


def write_observations(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> None:
    """Zstd Parquet with statistics, sorted inside each file so that row groups prune by time.

    Rows are spread by range over (site, logger, time): ranges are sampled, so a logger that
    holds much of the data is split over several files.
    """
    keys = [c for c in ("site_code", "logger_id", "timestamp_utc") if c in df.columns]
    tail = [c for c in ("sdi12_address", "thermistor_depth", "record", "file_hash") if c in df.columns]
    ordered = df.repartitionByRange(*keys, *tail).sortWithinPartitions(*keys, *tail)
    writer = ordered.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_sidecar(summary: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The one-row run summary as JSON."""
    summary.coalesce(1).write.mode(mode).json(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it back.

    Cuts lineage reliably and keeps columns prunable for the passes that follow.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A registry table, or an empty one before the first run."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)


REGISTRY_SCHEMA = "file_hash string, run_id string"
OUTPUTS_SCHEMA = (
    "output_id string, run_id string, object_store_path string, "
    "reproducibility_cartridge_path string, row_count bigint, published_at timestamp_ntz"
)


def new_hashes(existing: DataFrame, parsed: DataFrame) -> DataFrame:
    """Hashes not yet in the registry, once each."""
    return parsed.select("file_hash").distinct().join(existing.select("file_hash"), "file_hash", "left_anti")


def append_hashes(path: str, parsed: DataFrame, run_id: str) -> None:
    """Remember ingested hashes; those already known are ignored."""
    spark = parsed.sparkSession
    fresh = new_hashes(read_or_empty(spark, path, REGISTRY_SCHEMA), parsed)
    fresh.select("file_hash", F.lit(run_id).alias("run_id")).write.mode("append").parquet(path)


def append_output(path: str, entry: DataFrame) -> None:
    entry.write.mode("append").parquet(path)


def registered_outputs(outputs: DataFrame) -> DataFrame:
    """The output registry with exactly one row flagged latest."""
    return latest_flag(outputs)


def raw_copies(files: DataFrame, reports: DataFrame) -> DataFrame:
    """``(object_key, file_hash, content)`` of newly parsed files, once per hash.

    Reports name one Parsed path per hash, so the join on path keeps one copy of each.
    """
    wanted = reports.where(F.col("status") == "Parsed").select("path", "file_hash")
    return files.join(wanted, ["path", "file_hash"]).select(
        raw_file_key(F.col("file_hash")).alias("object_key"), "file_hash", "content"
    )
