"""Files arriving in a folder, processed batch by batch with the batch functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from xylemflow.operators.flatten import flatten_parsed_files
from xylemflow.plans.ingest import batch_reports, ingest_files, parsed_files, split_by_history
from xylemflow.sources import tables
from xylemflow.sources.rawfiles import identified

BINARY_FILE = (
    "path string, modificationTime timestamp_ltz, length bigint, content binary"
)


def arriving_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of raw files with their content hash."""
    stream = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return identified(stream.select("path", "content"))


def ingest_batch(registry: str, observations: str, reports: str, stream_id: str) -> Callable[[DataFrame, int], None]:
    """Batch function for ``foreachBatch``: parse never-seen files, append, then remember them.

    Output of a batch goes to a folder named by stream and batch and is overwritten on a retry;
    the hashes are remembered last. A repeated batch therefore leaves the same tables.
    ``stream_id`` belongs to one checkpoint folder: a new checkpoint counts its batches from 0
    again and needs a new id, or it would take earlier output for its own.
    """

    def process(files: DataFrame, batch_id: int) -> None:
        spark = files.sparkSession
        known = tables.read_or_empty(spark, registry, tables.REGISTRY_SCHEMA)
        run_id = f"{stream_id}-{batch_id}"
        history = known.where(F.col("run_id") != run_id)
        parsed = tables.stage(ingest_files(files, history).parsed, "parsed")
        fresh, seen = split_by_history(files.select("path", "file_hash"), history)
        batch_reports(fresh, seen, parsed).write.mode("overwrite").parquet(
            f"{reports}/stream={stream_id}/batch={batch_id}"
        )
        good = parsed_files(parsed)
        flatten_parsed_files(good).write.mode("overwrite").parquet(
            f"{observations}/stream={stream_id}/batch={batch_id}"
        )
        tables.append_hashes(registry, good, run_id)

    return process


def start_ingest(
    stream: DataFrame, registry: str, observations: str, reports: str, checkpoint: str, stream_id: str
) -> StreamingQuery:
    """Process what has arrived, then stop; call again (or schedule) for the next arrivals."""
    return (
        stream.writeStream.foreachBatch(ingest_batch(registry, observations, reports, stream_id))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
