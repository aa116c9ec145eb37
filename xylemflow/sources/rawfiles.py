"""Raw logger files as rows, identified by content hash."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of files that one task opens on average, and rows of one of its batches.
TASK_BYTES, BATCH_BYTES = 128 << 20, 16 << 20


def scan_raw_files(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """``path, content, length, modificationTime, file_hash`` of every file below the paths."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return identified(reader.load(paths if isinstance(paths, str) else list(paths)))


def scan_file_keys(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """``path, file_hash, length`` of every file: the bytes are read once, to hash them, and go no further."""
    return scan_raw_files(spark, paths, pattern).select("path", "file_hash", "length")


def identified(files: DataFrame) -> DataFrame:
    """Add the content hash to a frame with ``content`` bytes."""
    return files.withColumn("file_hash", F.sha2("content", 256))


def decoded(files: DataFrame) -> DataFrame:
    """Add ``text``: the content as UTF-8 without a byte-order mark, null where it is not UTF-8."""
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    text = F.when(valid, F.regexp_replace(F.col("content").cast("string"), "^﻿", ""))
    return files.withColumn("text", text)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    systems: dict[str, fs.FileSystem] = {}

    def content(path: str) -> bytes:
        scheme, _, rest = path.partition(":")
        if scheme == "file" or not rest:
            system, at = systems.setdefault("file", fs.LocalFileSystem()), "/" + (rest or path).lstrip("/")
        else:
            host = path[: path.index("/", len(scheme) + 3)] if path.startswith(f"{scheme}://") else scheme
            system, at = fs.FileSystem.from_uri(path) if host not in systems else (systems[host], systems[host].normalize_path(path[len(scheme) + 3 :]))
            systems[host] = system
        with system.open_input_stream(at) as stream:
            return stream.read()

    def rows(found: list[tuple[str, str, bytes]]) -> pa.RecordBatch:
        columns = list(zip(*found)) if found else [[]] * 3
        kinds = (pa.string(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "file_hash", "content"])

    held, size = [], 0
    for batch in batches:
        for path, file_hash in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            body = content(path)
            held.append((path, file_hash, body))
            size += len(body)
            if size >= BATCH_BYTES:
                yield rows(held)
                held, size = [], 0
    yield rows(held)


def open_files(keys: DataFrame) -> DataFrame:
    """``path, file_hash, content`` of the files that ``keys`` (``path, file_hash, length``) name.

    Only the thin keys are dealt out; each task then opens its own paths, so that no bytes are
    shuffled. Paths must be of a file system that Arrow opens (local, HDFS, S3, GCS, ABFS); for
    others use frames that carry ``content``.
    """
    total = keys.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(keys.sparkSession.sparkContext.defaultParallelism, -(-int(total) // TASK_BYTES))
    return keys.select("path", "file_hash").repartition(tasks, "path").mapInArrow(_opened, "path string, file_hash string, content binary")
