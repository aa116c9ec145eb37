"""Which hashes of a document also occur in other documents, found with packed postings.

Each task packs the hashes of some megabytes of text into one row per hash range, so that a
posting costs little more than its eight bytes in the shuffle. The number of ranges grows with the
data, so that a range stays small; hashes that a large share of the documents hold would break that
and are found beforehand in a bounded sample of documents (:func:`frequent_hashes`). They are known
to be shared, so their postings go to ranges of their own, split by document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xylemflow.llm.hashing import binary_column, binary_values, mix

#: Postings that one range holds on average, and those that a task packs together.
RANGE_POSTINGS, PACK_POSTINGS = 1 << 20, 1 << 19

PACKED = "part int, doc_keys binary, ranks binary, counts binary, hashes binary, positions binary"
#: What a range sends back: one row per bucket of documents, with the values of many of them.
RETURNED = "bucket int, doc_keys binary, ranks binary, counts binary, hashes binary, weights binary"
BY_DOCUMENT = "doc_key long, hashes binary, weights binary"
#: The bits of a hash that coarse postings keep, in six bytes.
COARSE = np.uint64(0xFFFFFFFFFFFF0000)


def range_count(postings: int, least: int = 1) -> int:
    return max(least, -(-postings // RANGE_POSTINGS), 1)


def bucket_count(postings: int) -> int:
    """Buckets of documents that ranges answer to.

    They follow the data alone, not the number of partitions: a range's answer then fills rows of
    hundreds of values for as long as there are no more ranges than that, however many tasks run.
    """
    return max(1, -(-postings // (RANGE_POSTINGS // 2)))


#: Documents of the sample that looks for frequent hashes, and in how many of them such a hash is.
SAMPLE_DOCUMENTS, SAMPLE_HITS = 2048, 16
#: Document keys that a task remembers, to pack copies once.
REMEMBERED_KEYS = 1 << 18
#: The weight of every frequent hash.
FREQUENT = (1 << 32) - 1


def bounded_sample(docs: DataFrame, rows: int, salt: int = 0) -> DataFrame:
    """About ``rows`` documents, the same ones in each run, chosen by the hash of ``doc_id``."""
    share = min(1.0, rows / max(1, docs.select("doc_id").count()))
    return docs.where(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 30)) < int(share * (1 << 30)))


#: Bytes of text that a sample of rows holds on average, whatever the length of texts.
SAMPLE_BYTES = 1 << 27


def sampled_texts(docs: DataFrame, rows: int) -> DataFrame:
    """``text`` of about ``rows`` rows with at most about :data:`SAMPLE_BYTES`, chosen row by row.

    Rows of one id, or without any, are chosen one by one, by text and place in the table.
    """
    total = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("b")).first()
    share = min(1.0, rows / max(1, total.n), SAMPLE_BYTES / max(1, total.b))
    draw = F.xxhash64("text", F.monotonically_increasing_id())
    return docs.where(F.pmod(draw, F.lit(1 << 30)) < int(share * (1 << 30))).select("text")


def frequent_hashes(sampled: DataFrame) -> np.ndarray:
    """Sorted hashes that at least :data:`SAMPLE_HITS` documents of a sample have.

    ``sampled`` has one row ``hash`` per document and distinct hash. The result is bounded by the
    sample's size, whatever the corpus holds.
    """
    rows = sampled.groupBy("hash").count().where(F.col("count") >= SAMPLE_HITS).select("hash").toPandas()
    return np.sort(rows["hash"].to_numpy(np.int64).view(np.uint64))


def contained(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set) or not len(values):
        return np.zeros(len(values), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def _coarse_column(hashes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return binary_column(np.ascontiguousarray(hashes.view(np.uint16).reshape(-1, 4)[:, 1:]).ravel(), 3 * bounds)


def pack(
    documents: Iterator[tuple[int, np.ndarray, np.ndarray | None, int | None]], parts: int, frequent: np.ndarray, coarse: bool = False
) -> Iterator[pa.RecordBatch]:
    """``(document key, hashes, their positions or None, rank or None)`` to rows of :data:`PACKED`.

    Frequent hashes get negative ranges, by a mixture of hash and document. Of documents with
    equal keys a task packs the first. Coarse postings drop the low bits of the hashes.
    """
    keys, sets, places, ranks, size, seen = [], [], [], [], 0, set()

    def flush() -> pa.RecordBatch:
        lengths = np.array([len(s) for s in sets], np.int64)
        hashes = np.concatenate(sets)
        part = (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int32)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), lengths)
        hot = np.flatnonzero(contained(hashes, frequent))
        spread = hashes[hot] + np.array(keys, np.int64).view(np.uint64)[owner[hot]]
        part[hot] = -1 - (spread % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part.astype(np.int16 if parts < 1 << 15 else np.int32), kind="stable")
        part, owner, hashes = part[order], owner[order], hashes[order]
        positions = np.concatenate(places)[order].astype(np.uint32) if places else np.zeros(0, np.uint32)
        cuts = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])))
        run_part = part[cuts]
        runs = np.flatnonzero(np.append(True, run_part[1:] != run_part[:-1]))
        counts = np.diff(np.append(cuts, len(hashes))).astype(np.uint32)
        run_bounds = np.append(runs, len(cuts))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(run_part[runs].astype(np.int32)),
                binary_column(np.array(keys, np.int64)[owner[cuts]], run_bounds),
                binary_column(np.array(ranks, np.int64)[owner[cuts]] if ranks else np.zeros(0, np.int64), run_bounds if ranks else np.zeros(len(runs) + 1, np.int64)),
                binary_column(counts, run_bounds),
                _coarse_column(hashes, np.append(cuts[runs], len(hashes))) if coarse else binary_column(hashes, np.append(cuts[runs], len(hashes))),
                binary_column(positions, np.append(cuts[runs], len(hashes)) if places else np.zeros(len(runs) + 1, np.int64)),
            ],
            names=["part", "doc_keys", "ranks", "counts", "hashes", "positions"],
        )

    for key, hashes, where, rank in documents:
        if key in seen:
            continue
        if len(seen) >= REMEMBERED_KEYS:
            seen.clear()
        seen.add(key)
        for low in range(0, len(hashes), PACK_POSTINGS):
            piece = hashes[low : low + PACK_POSTINGS]
            keys.append(key)
            sets.append(piece)
            if rank is not None:
                ranks.append(rank)
            if where is not None:
                places.append(where[low : low + PACK_POSTINGS])
            size += len(piece)
            if size >= PACK_POSTINGS:
                yield flush()
                keys, sets, places, ranks, size = [], [], [], [], 0
    if sets:
        yield flush()


def _unpacked(table: pa.Table, coarse: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, document keys, ranks (or keys) and positions of a range's postings, sorted by hash alone."""
    if coarse:
        short, _ = binary_values(table["hashes"], np.uint16)
        wide = np.zeros((len(short) // 3, 4), np.uint16)
        wide[:, 1:] = short.reshape(-1, 3)
        hashes = wide.ravel().view(np.uint64)
    else:
        hashes, _ = binary_values(table["hashes"], np.uint64)
    keys, _ = binary_values(table["doc_keys"], np.int64)
    ranks, _ = binary_values(table["ranks"], np.int64)
    counts, _ = binary_values(table["counts"], np.uint32)
    positions, _ = binary_values(table["positions"], np.uint32)
    owner = np.repeat(keys, counts)
    rank = np.repeat(ranks, counts) if len(ranks) else owner
    order = np.argsort(hashes)
    return hashes[order], owner[order], rank[order], positions[order] if len(positions) else positions


def _distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair of hash and document once, of pairs that are sorted by hash."""
    lengths = np.diff(np.append(_run_starts(hashes), len(hashes)))
    # A hash that stands alone is a distinct pair; only the others are compared by document.
    several = np.flatnonzero(np.repeat(lengths > 1, lengths))
    order = several[np.lexsort((owner[several], hashes[several]))]
    owner[several] = owner[order]
    fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])) if len(hashes) else np.zeros(0, bool)
    return hashes[fresh], owner[fresh]


def returned_rows(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, buckets: int, ranks: np.ndarray | None = None) -> pa.Table:
    """Values by document, in rows of :data:`RETURNED`; ``hashes`` may be left out (empty), so may ranks."""
    # Values meet by document first; then only the documents are ordered by bucket.
    order = np.argsort(owner)
    cuts = _run_starts(owner[order])
    lengths = np.diff(np.append(cuts, len(owner)))
    documents = owner[order[cuts]]
    bucket = (mix(documents.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    by_bucket = np.argsort(bucket, kind="stable")
    bucket, documents, lengths = bucket[by_bucket], documents[by_bucket], lengths[by_bucket]
    starts = np.cumsum(lengths) - lengths
    order = order[np.repeat(cuts[by_bucket] - starts, lengths) + np.arange(len(owner))]
    rows = _run_starts(bucket)
    row_bounds = np.append(rows, len(documents))
    value_bounds = np.append(starts[rows], len(owner))
    none = np.zeros(len(row_bounds), np.int64)
    return pa.Table.from_arrays(
        [
            pa.array(bucket[rows]), binary_column(documents, row_bounds),
            binary_column(owner[:0], none) if ranks is None else binary_column(ranks[order][starts], row_bounds),
            binary_column(lengths.astype(np.uint32), row_bounds),
            binary_column(hashes[order], value_bounds) if len(hashes) else binary_column(hashes, none),
            binary_column(weights[order].astype(np.uint32), value_bounds),
        ],
        names=["bucket", "doc_keys", "ranks", "counts", "hashes", "weights"],
    )


def returned_ranks(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    """The rank of each value of rows of :data:`RETURNED`."""
    ranks, _ = binary_values(table.column("ranks"), np.int64)
    return np.repeat(ranks, binary_values(table.column("counts"), np.uint32)[0])


def returned_values(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document keys, hashes and weights of rows of :data:`RETURNED`."""
    keys, _ = binary_values(table.column("doc_keys"), np.int64)
    counts, _ = binary_values(table.column("counts"), np.uint32)
    hashes, _ = binary_values(table.column("hashes"), np.uint64)
    weights, _ = binary_values(table.column("weights"), np.uint32)
    return np.repeat(keys, counts), hashes, weights


def _run_starts(hashes: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)


def _shared(table: pa.Table, buckets: int, coarse: bool) -> pa.Table:
    hashes, owner = _distinct(*_unpacked(table, coarse)[:2])
    counts = np.diff(np.append(_run_starts(hashes), len(hashes)))
    frequency = np.repeat(counts, counts)
    if table.num_rows and table["part"][0].as_py() < 0:
        frequency[:] = FREQUENT
    shared = frequency > 1
    return returned_rows(owner[shared], hashes[shared], frequency[shared], buckets)


def _later(table: pa.Table, buckets: int) -> pa.Table:
    hashes, owner, rank, positions = _unpacked(table)
    if table.num_rows and table["part"][0].as_py() < 0:
        return returned_rows(owner, hashes, positions, buckets, rank)
    starts = _run_starts(hashes)
    later = rank > np.repeat(np.minimum.reduceat(rank, starts) if len(starts) else rank, np.diff(np.append(starts, len(hashes))))
    return returned_rows(owner[later], hashes[:0], positions[later], buckets)


def _documents(table: pa.Table) -> pa.Table:
    owner, hashes, weights = returned_values(table)
    order = np.argsort(owner, kind="stable")
    cuts = _run_starts(owner[order])
    bounds = np.append(cuts, len(owner))
    cells = binary_column(hashes[order], bounds) if len(hashes) else binary_column(hashes, np.zeros(len(bounds), np.int64))
    return pa.Table.from_arrays([pa.array(owner[order][cuts]), cells, binary_column(weights[order], bounds)], names=["doc_key", "hashes", "weights"])


def shared_hashes(packed: DataFrame, buckets: int, coarse: bool = False) -> DataFrame:
    """Of each document, the hashes that another holds too, with the number of their documents."""
    return packed.groupBy("part").applyInArrow(lambda table: _shared(table, buckets, coarse), RETURNED)


def later_positions(packed: DataFrame, buckets: int) -> DataFrame:
    """Of each document, the positions (as weights) whose hash one of a smaller rank holds too.

    Rows with ``hashes`` hold all positions of frequent hashes: their ranges are split by document,
    and the smallest rank of each is an aggregate over these rows.
    """
    return packed.groupBy("part").applyInArrow(lambda table: _later(table, buckets), RETURNED)


def by_document(returned: DataFrame) -> DataFrame:
    """One row per document: ``doc_key, hashes, weights``, what all ranges returned."""
    return returned.groupBy("bucket").applyInArrow(_documents, BY_DOCUMENT)


def mapper(function: Callable, *arguments) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function with fixed further arguments."""
    return lambda batches: function(batches, *arguments)
