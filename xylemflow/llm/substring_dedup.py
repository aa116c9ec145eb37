"""Removal of byte strings that an earlier document already has, by difference-cover sampling.

Only the order of suffixes up to their first 50 bytes matters, so the difference-cover suffix sort
ends after one naming and never sorts most suffixes:

1. *Sample.* Positions ``p`` with ``p mod 21`` in the perfect difference set {0, 1, 4, 14, 16} are
   sampled. For any two positions there is a shift below 21 that takes both to sampled ones, so two
   equal 50-byte strings hold a common sampled prefix of 30 bytes.
2. *Sort and name.* The samples' 30-byte prefixes are sorted in ranges of their names (hashes).
   Names of one document only can be in no match; the others return to their documents.
3. *Merge the rest.* A suffix can match only if a returned sample lies at most 20 bytes behind its
   start. Those suffixes alone are named by their 50-byte prefixes and sorted, in :data:`ROUNDS`
   rounds over ranges of names, so that only a part of them is on disk at a time.
4. *Compare neighbours.* In sorted order, each prefix that follows an equal one of a smaller
   document is reported to its document, which marks the bytes.

Sample names drop the low bits of their hashes; a chance agreement there only adds work.

A document equal to one of a smaller ``doc_id`` is removed as a whole beforehand (by SHA-256) and
does not take part. Names are 64-bit hashes.

Strings are kept by text and compared by the smallest ``doc_id`` of that text.

Defined results: a null text is empty; texts below 50 bytes are kept; rows that share a ``doc_id``
do not remove each other's bytes, whatever their texts, but lose those of smaller ids each for itself;
a row with a null ``doc_id`` is kept whole and removes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.llm import postings as P
from xylemflow.llm.hashing import WINDOW, binary_values, prefix_sums, range_hashes, row_slices, text_bytes
from xylemflow.llm.staging import Staging

LENGTH = 50
#: A perfect difference set: every difference modulo 21 occurs.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
PREFIX = LENGTH - (PERIOD - 1)
ROUNDS = 3
#: Bytes of the rows that are hashed together: enough to outweigh the calls, few enough for the cache.
SLICE = 1 << 16

REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _sample_positions(n: int) -> np.ndarray:
    """Sampled positions of a text of ``n`` bytes that have a whole prefix."""
    turns = np.arange(0, max(0, n - PREFIX + 1), PERIOD)
    at = (turns[:, None] + np.array(COVER)).ravel()
    return at[at <= n - PREFIX]


def _at(text: np.ndarray, positions: np.ndarray, length: int, total: np.ndarray | None = None) -> np.ndarray:
    """Hashes of ``text[p : p + length]`` for ascending positions, window by window.

    ``total`` may hold the prefix sums of a text of one window.
    """
    if len(text) <= WINDOW:
        return range_hashes(prefix_sums(text) if total is None else total, positions, length)
    out = np.zeros(len(positions), np.uint64)
    step = WINDOW - length
    for low in range(0, len(text), step):
        a, b = np.searchsorted(positions, (low, low + step))
        if b > a:
            out[a:b] = range_hashes(prefix_sums(text[low : low + WINDOW]), positions[a:b] - low, length)
    return out


def _slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about :data:`SLICE` bytes with their bytes and row offsets."""
    flat, offsets = text_bytes(column)
    for low, high in row_slices(offsets, SLICE):
        start, end = int(offsets[low]), int(offsets[high])
        yield low, high, flat[start:end], offsets[low : high + 1] - start


def _samples(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sampled positions of all rows, ascending, and the n+1 bounds of each row's."""
    lengths = np.diff(offsets)
    pattern = _sample_positions(int(lengths.max()))
    counts = np.searchsorted(pattern, lengths - PREFIX, "right")
    bounds = np.append(0, np.cumsum(counts))
    at = pattern[np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts)] + np.repeat(offsets[:-1], counts)
    return at, bounds


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    flat, offsets = text_bytes(column)
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield flat[a:b]


def _sampled(batches: Iterator[pa.RecordBatch], parts: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    def documents() -> Iterator[tuple[int, np.ndarray, np.ndarray | None, None]]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for low, high, flat, offsets in _slices(batch.column(1)):
                at, bounds = _samples(offsets)
                names = _at(flat, at, PREFIX) & P.COARSE
                for i in range(high - low):
                    if offsets[i + 1] - offsets[i] >= LENGTH:
                        own = np.sort(names[bounds[i] : bounds[i + 1]])
                        yield keys[low + i], own[np.append(True, own[1:] != own[:-1])], None, None

    return P.pack(documents(), parts, frequent, coarse=True)


def _candidates(flat: np.ndarray, offsets: np.ndarray, names: list[np.ndarray], total: np.ndarray | None = None) -> np.ndarray:
    """Starts of 50-byte strings that have a sample with one of their row's sorted names close behind."""
    at, bounds = _samples(offsets)
    hashes = _at(flat, at, PREFIX, total) & P.COARSE
    hit = np.zeros(len(flat) + PERIOD, bool)
    for low, high, own in zip(bounds[:-1], bounds[1:], names):
        hit[at[low:high]] = P.contained(hashes[low:high], own)
    hits = np.append(0, np.cumsum(hit, dtype=np.int32))
    near = hits[PERIOD : PERIOD + len(flat)] > hits[: len(flat)]
    # No string begins in a row's last bytes; the samples of the next row are too far for the others.
    ends = (offsets[1:, None] - np.arange(1, LENGTH)).ravel()
    near[ends[ends >= 0]] = False
    return np.flatnonzero(near)


def _merged(batches: Iterator[pa.RecordBatch], parts: int, frequent: np.ndarray, turn: int) -> Iterator[pa.RecordBatch]:
    def documents() -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        for batch in batches:
            names, cells = binary_values(batch.column(3), np.uint64)
            keys, ranks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for low, high, flat, offsets in _slices(batch.column(2)):
                total = prefix_sums(flat) if len(flat) <= WINDOW else None
                own = [np.sort(names[cells[i] : cells[i + 1]]) for i in range(low, high)]
                at = _candidates(flat, offsets, own, total)
                found = _at(flat, at, LENGTH, total)
                now = ((found >> np.uint64(32)) * np.uint64(ROUNDS)) >> np.uint64(32) == turn
                at, found = at[now], found[now]
                bounds = np.searchsorted(at, offsets)
                for i in np.flatnonzero(np.diff(bounds)):
                    a, b = bounds[i], bounds[i + 1]
                    yield keys[low + i], found[a:b], at[a:b] - offsets[i], ranks[low + i]

    return P.pack(documents(), parts, frequent)


def _all_strings(batches: Iterator[pa.RecordBatch], length: int, sampled_only: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in _texts(batch.column(0)):
            if len(text) >= LENGTH:
                at = _sample_positions(len(text)) if sampled_only else np.arange(len(text) - length + 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(_at(text, at, length)).view(np.int64))], names=["hash"])


def _least_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, the smallest document of each frequent string."""
    for batch in batches:
        _, hashes, _ = P.returned_values(batch)
        owner = P.returned_ranks(batch)
        order = np.lexsort((owner, hashes))
        hashes, owner = hashes[order].view(np.int64), owner[order]
        first = np.append(True, hashes[1:] != hashes[:-1]) if len(hashes) else np.zeros(0, bool)
        yield pa.RecordBatch.from_arrays([pa.array(hashes[first]), pa.array(owner[first])], names=["hash", "doc_id"])


def _frequent_later(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, owners: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Of all positions of frequent strings, those of which a smaller document has the string."""
    for batch in batches:
        owner, hashes, positions = P.returned_values(batch)
        later = owners[np.searchsorted(frequent, hashes)] < P.returned_ranks(batch)
        yield from P.returned_rows(owner[later], hashes[:0], positions[later], buckets).to_batches()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A document's positions to the borders of the maximal byte runs that their strings cover."""
    for batch in batches:
        positions, bounds = binary_values(batch.column(2), np.uint32)
        borders = []
        for low, high in zip(bounds[:-1], bounds[1:]):
            at = np.sort(positions[low:high]).astype(np.int64)
            cut = np.flatnonzero(np.diff(at) > LENGTH)
            runs = np.stack([at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + LENGTH], 1) if len(at) else np.zeros((0, 2), np.int64)
            borders.append(runs.astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(borders, pa.binary())], names=["doc_key", "runs"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decisions and kept text of rows ``doc_id, text, copy, runs``."""
    for batch in batches:
        rows, kept = [], []
        for doc_id, text, copy, runs in zip(
            batch.column(0).to_pylist(), _texts(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()
        ):
            n = len(text)
            borders = np.frombuffer(runs or b"", "<i8").reshape(-1, 2)
            if copy and n >= LENGTH:
                borders = np.array([[0, n]])
            data, parts, end = text.tobytes(), [], 0
            for a, b in borders.tolist():
                parts.append(data[end:a])
                end = b
            rest = b"".join([*parts, data[end:]])
            kept.append(rest)
            rows.append((doc_id, n, n - len(rest), len(borders), hashlib.sha256(rest).hexdigest()))
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(columns[i], pa.int64()) for i in range(4)), pa.array(columns[4], pa.string()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """:data:`REMOVED` and the ``kept`` bytes of every row of ``docs`` (``doc_id``, ``text``).

    The kept bytes may end inside a character, as strings are cut by byte.
    """
    spark = docs.sparkSession
    staging = Staging(spark, "substring-dedup")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    digest = F.sha2("text", 256)
    key = F.conv(F.substring("sha", 1, 15), 16, 10).cast("long")
    thin = staging.table(source.select("doc_id", digest.alias("sha"), F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    classes = staging.table(
        thin.where("doc_id IS NOT NULL").groupBy("sha").agg(F.min("doc_id").alias("least_id"), F.max("n_bytes").alias("n_bytes"))
        .withColumn("class_nr", F.monotonically_increasing_id()),
        "classes",
    )
    total = classes.agg(F.sum("n_bytes")).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))

    sample = P.sampled_texts(source.select("text"), P.SAMPLE_DOCUMENTS)
    frequent = np.unique(P.frequent_hashes(sample.mapInArrow(P.mapper(_all_strings, PREFIX, True), "hash long")) & P.COARSE)
    parts = P.range_count(total * len(COVER) // PERIOD, least)
    buckets = P.bucket_count(total * len(COVER) // PERIOD)
    named = source.where("doc_id IS NOT NULL").select(digest.alias("sha"), "text").select(key.alias("key"), "text")
    packed = named.mapInArrow(P.mapper(_sampled, parts, frequent), P.PACKED)
    names = staging.table(P.shared_hashes(packed, buckets, coarse=True), "names")
    of_class = staging.table(
        classes.select(key.alias("doc_key"), "sha", "least_id", "class_nr").join(P.by_document(names), "doc_key")
        .select("sha", F.col("least_id").alias("doc_id"), "class_nr", F.col("hashes").alias("names")),
        "class-names",
    )
    staging.drop(names)

    often = P.frequent_hashes(sample.mapInArrow(P.mapper(_all_strings, LENGTH, False), "hash long"))
    keyed = source.withColumn("sha", digest)
    with_names = keyed.join(of_class, ["sha", "doc_id"]).select("class_nr", "doc_id", "text", "names")
    rounds = [
        staging.table(P.later_positions(with_names.mapInArrow(P.mapper(_merged, parts, often, turn), P.PACKED), buckets), "later") for turn in range(ROUNDS)
    ]
    staging.drop(of_class)
    later = rounds[0]
    for other in rounds[1:]:
        later = later.unionByName(other)
    hot = later.where(F.octet_length("hashes") > 0)
    # At most the frequent strings of the bounded sample.
    least_owners = hot.mapInArrow(_least_owners, "hash long, doc_id long").groupBy("hash").agg(F.min("doc_id").alias("doc_id"))
    owner_of = {r["hash"]: r["doc_id"] for r in least_owners.collect()}
    owners = np.array([owner_of.get(h, 0) for h in often.view(np.int64).tolist()], np.int64)
    plain = later.where(F.octet_length("hashes") == 0).unionByName(hot.mapInArrow(P.mapper(_frequent_later, often, owners, buckets), P.RETURNED))
    runs = staging.table(P.by_document(plain).mapInArrow(_runs, "doc_key long, runs binary"), "runs")
    staging.drop(*rounds)

    decided = (
        thin.where("doc_id IS NOT NULL").select("sha", "doc_id").distinct()
        .join(classes.select("sha", "least_id", "class_nr"), "sha")
        .select("sha", "doc_id", (F.col("doc_id") > F.col("least_id")).alias("copy"), "class_nr")
        .join(runs, F.col("class_nr") == F.col("doc_key"), "left")
        .where("copy OR runs IS NOT NULL")
        .select("sha", "doc_id", "copy", "runs")
    )
    final = keyed.join(staging.table(decided, "decided"), ["sha", "doc_id"], "left").select(
        "doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "runs"
    )
    return final.mapInArrow(_removed, REMOVED + ", kept binary")
