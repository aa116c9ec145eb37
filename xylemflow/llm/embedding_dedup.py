"""Near copies among embeddings of one label, by random-hyperplane sign hashing.

1. Equal vectors of a label are one class with its size, so that copies cost one entry.
2. Each class gets one code a table: the signs of its products with ``bits`` random planes. Two
   vectors at the threshold agree in one table with ``p = (1 - angle / pi) ** bits``. ``bits`` grows
   with the largest label, so that a random bucket keeps about :data:`BUCKET` classes, and the
   number of tables with ``p``, so that such a pair is missed with a chance of :data:`MISS` at any
   size; closer pairs are missed less.
3. Buckets of one class are dropped. The others are cut into blocks of about :data:`BLOCK` classes,
   and each two blocks of a bucket meet in one cell, so that no task holds a large bucket. Some
   tables at a time are sent, so that the vectors are on disk a few times only.
4. A cell computes all cosines in double precision. A pair counts in the first table that brings
   it together, and no pair leaves the cell: each class sends its number of links and the smallest
   class it hangs together with there.
5. Those edges give distributed connected components.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components, and
one without a label, links with nothing; vectors of different length are not compared; repeated
rows are separate rows; a null ``vec_id`` is a component's id only if all its ids are null; labels
are compared as text; other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.llm.components import connected_components
from xylemflow.llm.hashing import binary_column, binary_values
from xylemflow.llm.postings import mapper
from xylemflow.llm.staging import Staging

COSINE = 0.93
#: The chance to miss a pair at the threshold, and classes of a bucket that only chance fills.
MISS, BUCKET = 0.001, 64
LEAST_BITS, MOST_BITS = 6, 60
#: Classes of one block of a bucket, and tables that are sent together.
BLOCK, TABLES_AT_ONCE = 512, 4
#: Cosines this close to the threshold are computed again with exact sums.
CLOSE = 1e-9
SEED = 12

VECTORS = "row_nr long, vec_id long, label string, dim int, digest binary, vector binary"
CODED = "class_id long, label string, dim int, size long, vector binary, codes binary"
FOUND = "class_id long, links long, root long"


def plan(classes: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """Bits of a code and number of tables for the largest label's number of classes."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, classes) / BUCKET))))
    together = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-together))


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims, digests, vectors = [], [], []
        labels = batch.column(2).is_valid().to_pylist()
        for labelled, values in zip(labels, batch.column(3)):
            x = None
            if labelled and values.is_valid and len(values.values) and not values.values.null_count:
                x = np.asarray(values.values.to_numpy(zero_copy_only=False), np.float64)
                x = x if np.isfinite(x).all() and x.any() else None
            body = None if x is None else x.astype("<f8").tobytes()
            dims.append(None if x is None else len(x))
            digests.append(None if x is None else hashlib.sha256(body).digest())
            vectors.append(body)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())],
            names=["row_nr", "vec_id", "label", "dim", "digest", "vector"],
        )


def _planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, tables * bits))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by a power of two first, so that no square overflows."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    scaled = np.ldexp(vectors, -exponent)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _coded(batches: Iterator[pa.RecordBatch], bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    planes: dict[int, np.ndarray] = {}
    powers = 1 << np.arange(bits, dtype=np.int64)
    for batch in batches:
        dims = batch.column(2).to_numpy()
        codes = np.zeros((len(dims), tables), np.int64)
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            planes.setdefault(dim, _planes(dim, bits, tables))
            matrix = binary_values(batch.column(4).take(pa.array(at)), "<f8")[0].reshape(-1, dim)
            signs = (unit(matrix) @ planes[dim] >= 0).reshape(len(at), tables, bits)
            codes[at] = signs @ powers
        cells = binary_column(codes.ravel(), np.arange(len(dims) + 1) * tables)
        yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=["class_id", "label", "dim", "size", "vector", "codes"])


def _entries(batches: Iterator[pa.RecordBatch], low: int, high: int) -> Iterator[pa.RecordBatch]:
    """One thin row per class and table in ``low..high``."""
    for batch in batches:
        codes = binary_values(batch.column(3), np.int64)[0].reshape(batch.num_rows, -1)[:, low:high]
        width = codes.shape[1]
        at = pa.array(np.repeat(np.arange(batch.num_rows), width))
        numbers = pa.array(np.tile(np.arange(low, low + width, dtype=np.int32), batch.num_rows))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), batch.column(2).take(at), numbers, pa.array(codes.ravel())],
            names=["class_id", "label", "dim", "table", "code"],
        )


ENTRIES = "class_id long, label string, dim int, table int, code long"


def _linked_pairs(left: np.ndarray, right: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs whose cosine is at least the threshold."""
    similar = left @ right.T
    i, j = np.nonzero(similar >= cosine - CLOSE)
    close = np.flatnonzero(similar[i, j] <= cosine + CLOSE)
    below = [k for k in close if _exact_cosine(left[i[k]], right[j[k]]) < cosine]
    return np.delete(i, below), np.delete(j, below)


def _exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes hangs together with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        following = root.copy()
        np.minimum.at(following, i, low)
        np.minimum.at(following, j, low)
        following = following[following]
        if (following == root).all():
            return root
        root = following


def _cell(table: int, blocks: np.ndarray, ids: np.ndarray, sizes: np.ndarray, vectors: np.ndarray, codes: np.ndarray, cosine: float):
    """Links and local roots of one cell: of one block with itself, or of two blocks."""
    cut = int(np.searchsorted(blocks, blocks[-1]))
    y = unit(vectors)
    if cut:
        i, j = _linked_pairs(y[:cut], y[cut:], cosine)
        j = j + cut
    else:
        i, j = _linked_pairs(y, y, cosine)
        i, j = i[i < j], j[i < j]
    # A pair that an earlier table has together is counted there.
    new = ~(codes[i, :table] == codes[j, :table]).any(axis=1)
    i, j = i[new], j[new]
    links = np.bincount(i, weights=sizes[j], minlength=len(ids)) + np.bincount(j, weights=sizes[i], minlength=len(ids))
    met = np.flatnonzero(links)
    order = np.argsort(ids)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(ids))
    roots = ids[order][_roots(len(ids), rank[i], rank[j])][rank]
    return ids[met], links[met].astype(np.int64), roots[met]


def _cells(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell to :data:`FOUND`; a cell may go on in the next batch."""

    def solved(rows: pa.Table) -> pa.RecordBatch | None:
        rows = rows.combine_chunks()
        keys = np.stack([rows[c].to_numpy() for c in ("bucket", "low", "high")])
        starts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
        tables, blocks, ids, sizes = (rows[c].to_numpy() for c in ("table", "block", "class_id", "size"))
        vectors, at = binary_values(rows["vector"], "<f8")
        codes = binary_values(rows["codes"], np.int64)[0].reshape(rows.num_rows, -1)
        out = []
        for a, b in zip(starts, np.append(starts[1:], rows.num_rows)):
            if b - a > 1 and (keys[1, a] == keys[2, a] or blocks[a] != blocks[b - 1]):
                matrix = vectors[at[a] : at[b]].reshape(b - a, -1)
                out.append(_cell(tables[a], blocks[a:b], ids[a:b], sizes[a:b], matrix, codes[a:b], cosine))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["class_id", "links", "root"])

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = tuple(batch.column(i)[batch.num_rows - 1].as_py() for i in range(3))
        first = tuple(batch.column(i)[0].as_py() for i in range(3))
        if first == last:
            if waiting and tuple(waiting[-1].column(i)[waiting[-1].num_rows - 1].as_py() for i in range(3)) != first:
                yield solved(pa.Table.from_batches(waiting))
                waiting = []
            waiting.append(batch)
            continue
        same = np.ones(batch.num_rows, bool)
        for i in range(3):
            same &= batch.column(i).to_numpy() == last[i]
        cut = int(np.argmax(same))
        yield solved(pa.Table.from_batches([*waiting, batch.slice(0, cut)]))
        waiting = [batch.slice(cut)]
    if waiting:
        yield solved(pa.Table.from_batches(waiting))


def _cells_of(entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each class of a shared bucket once per block that its own block meets, itself included."""
    key = ["label", "dim", "table", "code"]
    placed = entries.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return met.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "table", "class_id")


def near_copies(embeddings: DataFrame, cosine: float = COSINE, miss: float = MISS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    ``embeddings`` has ``vec_id``, the array ``embedding`` and ``label``.
    """
    spark = embeddings.sparkSession
    staging = Staging(spark, "embedding-dedup")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = embeddings.select(
        F.monotonically_increasing_id().alias("row_nr"), F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>")
    )
    vectors = staging.table(source.mapInArrow(_usable, VECTORS), "vectors")
    classes = staging.table(
        vectors.where(F.col("digest").isNotNull()).groupBy("label", "digest").agg(
            F.min("row_nr").alias("class_id"), F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("least_id"), F.min("dim").alias("dim"), F.min("vector").alias("vector")
        ),
        "classes",
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(largest, cosine, miss)
    coded = staging.table(classes.select("class_id", "label", "dim", "size", "vector").mapInArrow(mapper(_coded, bits, tables), CODED), "coded")
    thin = coded.select("class_id", "label", "dim", "codes")
    sizes = staging.table(
        thin.mapInArrow(mapper(_entries, 0, tables), ENTRIES).groupBy("label", "dim", "table", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("label", "dim", "table", "code", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"), F.monotonically_increasing_id().alias("bucket")),
        "buckets",
    )
    found = None
    for low in range(0, tables, TABLES_AT_ONCE):
        high = min(tables, low + TABLES_AT_ONCE)
        entries = thin.mapInArrow(mapper(_entries, low, high), ENTRIES)
        cells = _cells_of(entries, sizes.where(F.col("table").between(low, high - 1))).join(coded.select("class_id", "size", "vector", "codes"), "class_id")
        ordered = (
            cells.select("bucket", "low", "high", "block", "table", "class_id", "size", "vector", "codes")
            .repartition(partitions, "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "block")
        )
        part = staging.table(ordered.mapInArrow(mapper(_cells, cosine), FOUND), "found")
        found = part if found is None else found.unionByName(part)

    components = connected_components(found.where("class_id <> root").select(F.col("class_id").alias("a"), F.col("root").alias("b")), staging)
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    named = staging.table(
        classes.select("label", "digest", "class_id", "size", "least_id").join(components.withColumnRenamed("node", "class_id"), "class_id", "left")
        .withColumn("component", F.coalesce("component", "class_id")).join(links, "class_id", "left"),
        "named",
    )
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = staging.table(
        named.join(least, "component").select("label", "digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id"), "class-results"
    )
    usable = vectors.select("vec_id", "label", "digest").where(F.col("digest").isNotNull()).join(of_class, ["label", "digest"]).select("vec_id", "n_links", "component_id")
    alone = vectors.where(F.col("digest").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return usable.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
