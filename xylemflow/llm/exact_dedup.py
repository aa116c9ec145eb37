"""Exact deduplication by composable polynomial fingerprints.

Fixed-size chunks of a text are hashed independently of each other, and the hash of the whole is
their combination, each shifted by the bytes before it: ``H(A + B) = H(A) + r**len(A) * H(B)``
modulo a Mersenne prime, for two bases. Texts with equal fingerprint and length are then compared
chunk by chunk in a sorted stream; groups above :data:`STREAM_ROWS` rows are compared in several
streams, whose first texts are compared in turn. Fingerprints that different texts share are told
apart by SHA-256.

Defined results: a null text counts as empty; of equal texts the row with the largest ``doc_id``
stays, null ids rank lowest, and of rows that also agree in ``doc_id`` exactly one stays. Other
columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.llm.hashing import row_slices, text_bytes
from xylemflow.llm.staging import Staging, unique_names

CHUNK = 1 << 16
PRIME = (1 << 31) - 1
BASES = (1_000_003, 1_566_083_941)
#: Rows of one group that a single stream compares.
STREAM_ROWS = 1000

FINGERPRINT_SCHEMA = "doc_id long, row_nr long, n_bytes long, fingerprint long, text_sha256 string"
_P = np.uint64(PRIME)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse for the positions of a chunk's window."""
    if base not in _POWERS:
        out = []
        for r in (base, pow(base, -1, PRIME)):
            p = np.ones(1, np.uint64)
            while len(p) <= CHUNK:
                p = np.concatenate([p, p * np.uint64(pow(r, len(p), PRIME)) % _P])
            out.append(p[: CHUNK + 1])
        _POWERS[base] = tuple(out)
    return _POWERS[base]


def chunk_hashes(b: np.ndarray, bounds: np.ndarray, base: int) -> np.ndarray:
    """Hash of each range ``b[bounds[i] : bounds[i + 1]]``; ``b`` is at most a chunk long."""
    power, inverse = _powers(base)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[: len(b)] % _P, out=total[1:])
    return (total[bounds[1:]] - total[bounds[:-1]]) % _P * inverse[bounds[:-1]] % _P


def combine(hashes: list[int], lengths: list[int], base: int) -> int:
    """Fingerprint of the concatenation of ranges with these hashes and lengths."""
    total, shift = 0, 1
    for h, n in zip(hashes, lengths):
        total = (total + shift * h) % PRIME
        shift = shift * pow(base, n, PRIME) % PRIME
    return total


def fingerprints(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 62-bit fingerprint for each row of a text buffer."""
    out = np.zeros((len(offsets) - 1, 2), np.int64)
    for low, high in row_slices(offsets, CHUNK):
        start, end = int(offsets[low]), int(offsets[high])
        for k, base in enumerate(BASES):
            if end - start <= CHUNK:
                out[low:high, k] = chunk_hashes(flat[start:end], offsets[low : high + 1] - start, base).astype(np.int64)
            else:
                cuts = [*range(start, end, CHUNK), end]
                hashes = [int(chunk_hashes(flat[a:b], np.array([0, b - a]), base)[0]) for a, b in zip(cuts, cuts[1:])]
                out[low, k] = combine(hashes, [b - a for a, b in zip(cuts, cuts[1:])], base)
    return (out[:, 0] << 31) | out[:, 1]


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, offsets = text_bytes(batch.column(2))
        view = memoryview(flat)
        digests = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.diff(offsets)), pa.array(fingerprints(flat, offsets)), pa.array(digests, pa.string())],
            names=["doc_id", "row_nr", "n_bytes", "fingerprint", "text_sha256"],
        )


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, offsets = text_bytes(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), pa.array(fingerprints(flat, offsets)), batch.column(1)],
            names=["doc_id", "n_bytes", "fingerprint", "text"],
        )


def _equal(a: np.ndarray, b: np.ndarray) -> bool:
    """Chunkwise comparison that ends at the first difference."""
    return len(a) == len(b) and all(np.array_equal(a[i : i + CHUNK], b[i : i + CHUNK]) for i in range(0, len(a), CHUNK))


def _stream_compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``(fingerprint, n_bytes, streams, text)`` to the distinct texts that matter further.

    The first text of a stream goes on if its group has several streams; every text that differs
    from the first marks a shared fingerprint.
    """
    group, firsts = None, []
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(4))))
        flat, offsets = text_bytes(batch.column(4))
        rows = []
        for i, key in enumerate(keys):
            text = flat[offsets[i] : offsets[i + 1]]
            if key != group:
                group, firsts = key, [text.copy()]
                if key[2] > 1:
                    rows.append((i, False))
            elif not any(_equal(text, other) for other in firsts):
                firsts.append(text.copy())
                rows.append((i, True))
        at = pa.array([i for i, _ in rows], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), batch.column(4).take(at), pa.array([d for _, d in rows], pa.bool_())],
            names=["fingerprint", "n_bytes", "text", "differs"],
        )


_COMPARED = "fingerprint long, n_bytes long, text string, differs boolean"


def _compare(texts: DataFrame) -> DataFrame:
    """Frames with ``fingerprint, n_bytes, streams, stream, text`` to :func:`_stream_compare` rows."""
    keys = ["fingerprint", "n_bytes", "streams", "stream"]
    return texts.select(*keys, "text").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_stream_compare, _COMPARED)


def copy_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, row_nr, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    ``row_nr`` is the row's ``monotonically_increasing_id`` in ``docs``.
    """
    staging = Staging(docs.sparkSession, "exact-dedup")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    thin = staging.table(
        source.select("doc_id", F.monotonically_increasing_id().alias("row_nr"), "text").mapInArrow(_fingerprint_batches, FINGERPRINT_SCHEMA),
        "fingerprints",
    )
    key = ["fingerprint", "n_bytes"]
    suspects = thin.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    texts = (
        source.mapInArrow(_text_batches, "doc_id long, n_bytes long, fingerprint long, text string")
        .join(suspects, key)
        .withColumn("streams", F.ceil(F.col("copies") / STREAM_ROWS))
        .withColumn("stream", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), "streams"))
    )
    first = staging.table(_compare(texts), "compared")
    heads = first.where("NOT differs").withColumns({"streams": F.lit(1).cast("long"), "stream": F.lit(0).cast("long")})
    shared = staging.table(
        first.where("differs").select(*key).unionByName(_compare(heads).where("differs").select(*key)).distinct(), "shared"
    )
    staging.drop(first)
    told = thin.join(shared.withColumn("_shared", F.lit(True)), key, "left").withColumn(
        "variant", F.when(F.col("_shared"), F.col("text_sha256")).otherwise(F.lit(""))
    )
    group = [*key, "variant"]
    # Staged, so that the join below has exchanges of its own and AQE may split a large group.
    groups = staging.table(
        told.groupBy(*group).agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row_nr")).alias("_last")),
        "groups",
    )
    return told.join(groups, group).select(
        "doc_id",
        "row_nr",
        F.col("_last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_nr") == F.col("_last.row_nr")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts; ``docs`` must be a plain scan."""
    (row,) = unique_names(docs.columns, "_row")
    kept = copy_groups(docs).where("kept").select(F.col("row_nr").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
