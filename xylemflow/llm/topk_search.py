"""Exact top-k inner-product search with a vector-approximation file.

Every component is cut to one of 256 cells. The scan reads the cells only: per query and vector
they bound the score from both sides, and a vector stays a candidate while its upper bound reaches
the (k+1)-th best lower bound. Exact vectors are then read in the order of the bounds: first the
k+1 candidates with the best upper bounds of each query, then those others whose upper bound still
reaches the (k+1)-th exact score; after that the result is certain.

Equal vectors are one class, kept with its k+1 smallest ids, so that a very common vector costs
one entry and its queries one search. The query set meets the index in a grid of blocks: an index
block is sent once to each block of :data:`QUERY_BLOCK` queries.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part;
vectors of different length are not compared; rows that repeat a ``vec_id`` are separate rows, each
a candidate of the others; a null ``vec_id`` is no query and ranks last among equal scores.
Components are cut to :data:`MOST` in 256ths, and scores that do not fit 64 bits are cut to them.
Where products are too large for doubles to be exact, the bounds are widened by the rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from xylemflow.llm.hashing import binary_values
from xylemflow.llm.postings import mapper
from xylemflow.llm.staging import Staging

K, EVERY, SCALE = 5, 50, 256
CELLS, INDEX_BLOCK, QUERY_BLOCK, SALTS = 256, 4096, 1024, 64
MOST = 1 << 61

VECTORS = "row_nr long, vec_id long, dim int, least long, most long, vector binary"


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(2)
        rows = []
        for i, values in enumerate(lists):
            x = values.values
            if values.is_valid and len(x) and not x.null_count:
                with np.errstate(over="ignore"):
                    v = np.floor(SCALE * np.asarray(x.to_numpy(zero_copy_only=False), np.float64))
                if np.isfinite(np.asarray(x.to_numpy(zero_copy_only=False), np.float64)).all():
                    v = np.clip(v, -MOST, MOST)
                    narrow = np.abs(v).max() < 1 << 31
                    rows.append((i, len(v), int(v.min()), int(v.max()), v.astype("<i4" if narrow else "<i8").tobytes()))
        at, dims, least, most, cells = zip(*rows) if rows else ([],) * 5
        at = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(dims, pa.int32()), pa.array(least, pa.int64()), pa.array(most, pa.int64()), pa.array(cells, pa.binary())],
            names=["row_nr", "vec_id", "dim", "least", "most", "vector"],
        )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of one dimension; those with large components have eight bytes each."""
    lengths = pc.binary_length(column).to_numpy()
    out = np.zeros((len(column), dim), np.int64)
    for size, dtype in ((4, "<i4"), (8, "<i8")):
        at = np.flatnonzero(lengths == size * dim)
        out[at] = binary_values(column.take(pa.array(at)), dtype)[0].reshape(-1, dim)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], size: int, low: int, width: int, cells: bool) -> Iterator[pa.RecordBatch]:
    """``dim, class_id, vector`` to rows ``dim, ids, body`` of up to ``size`` vectors or their cells."""
    for batch in batches:
        dims = batch.column(0).to_numpy()
        rows = []
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            for start in range(0, len(at), size):
                part = pa.array(at[start : start + size])
                matrix = _matrix(batch.column(2).take(part), int(dim))
                body = ((matrix - low) // width).astype(np.uint8) if cells else matrix
                rows.append((int(dim), batch.column(1).take(part).to_numpy().tobytes(), np.ascontiguousarray(body).tobytes()))
        columns = list(zip(*rows)) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], names=["dim", "ids", "body"])


def _scan(batches: Iterator[pa.RecordBatch], low: int, width: int, keep: int) -> Iterator[pa.RecordBatch]:
    """Score bounds of a query block against an index block's cells, where they may matter."""
    for batch in batches:
        for dim, q_ids, q_body, ids, cells in zip(*(batch.column(i).to_pylist() for i in range(5))):
            queries = np.frombuffer(q_body, "<i8").reshape(-1, dim).astype(np.float64)
            floor = low + width * np.frombuffer(cells, np.uint8).reshape(-1, dim).astype(np.float64)
            base = queries @ floor.T
            lower = base + (width - 1) * np.minimum(queries, 0).sum(1)[:, None]
            upper = base + (width - 1) * np.maximum(queries, 0).sum(1)[:, None]
            reach = np.abs(queries).sum(1)[:, None] * float(max(abs(low), abs(low + CELLS * width)))
            if reach.max(initial=0) >= 1 << 53:
                slack = reach * (4 * dim + 16) * np.finfo(float).eps
                lower, upper = lower - slack, upper + slack
            if lower.shape[1] > keep:
                reach = np.partition(lower, lower.shape[1] - keep, axis=1)[:, lower.shape[1] - keep]
                q, v = np.nonzero(upper >= reach[:, None])
            else:
                q, v = np.nonzero(np.ones(lower.shape, bool))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(q_ids, np.int64)[q]), pa.array(np.frombuffer(ids, np.int64)[v]),
                    pa.array(lower[q, v]), pa.array(upper[q, v]),
                ],
                names=["query_class", "class_id", "lower", "upper"],
            )


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column(4).to_numpy()
        scores = np.zeros(len(dims), np.int64)
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            left, right = (_matrix(batch.column(i).take(pa.array(at)), dim) for i in (2, 3))
            if float(np.abs(left).max()) * float(np.abs(right).max()) * dim < 1 << 62:
                scores[at] = (left * right).sum(axis=1)
            else:
                exact = (left.astype(object) * right.astype(object)).sum(axis=1)
                scores[at] = [min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in exact]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], names=["query_class", "class_id", "score"])


def _best(rows: DataFrame, group: str, order: list, keep: int) -> DataFrame:
    """The first ``keep`` rows of each group, thinned in salted parts first."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    for keys in ([group, "_salt"], [group]):
        salted = salted.withColumn("_nr", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_nr") <= keep)
    return salted.drop("_salt", "_nr")


def _exact(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    both = pairs.select("query_class", "class_id").join(classes.select("class_id", "dim", F.col("vector").alias("v")), "class_id")
    both = both.join(classes.select(F.col("class_id").alias("query_class"), F.col("vector").alias("q")), "query_class")
    return both.select("query_class", "class_id", "q", "v", "dim").mapInArrow(_scores, "query_class long, class_id long, score long")


def top_k(embeddings: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best other rows for each row with ``vec_id % every = 0``.

    ``embeddings`` has ``vec_id`` and the array ``embedding``.
    """
    spark = embeddings.sparkSession
    staging = Staging(spark, "top-k")
    keep = k + 1
    source = embeddings.select(F.monotonically_increasing_id().alias("row_nr"), F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>"))
    vectors = staging.table(source.mapInArrow(_quantised, VECTORS), "vectors")
    low, high = vectors.agg(F.min("least"), F.max("most")).first()
    low, high = low or 0, high or 0
    width = -(-(high - low + 1) // CELLS)

    by_id = [F.col("vec_id").asc_nulls_last(), F.col("row_nr")]
    members = staging.table(_best(vectors.select("vector", "dim", "vec_id", "row_nr"), "vector", by_id, keep), "members")
    classes = staging.table(
        members.groupBy("vector", "dim").agg(F.min("row_nr").alias("class_id"), F.collect_list(F.struct("vec_id", "row_nr")).alias("members")), "classes"
    )
    asked = staging.table(
        vectors.where(F.col("vec_id") % every == 0).select("vec_id", "row_nr", "vector").join(classes.select("vector", "class_id"), "vector").select(
            F.col("vec_id").alias("query_id"), F.col("row_nr").alias("query_row"), F.col("class_id").alias("query_class")
        ),
        "queries",
    )
    query_vectors = classes.join(asked.select(F.col("query_class").alias("class_id")).distinct(), "class_id", "left_semi")
    block = "dim int, ids binary, body binary"
    packed = staging.table(query_vectors.select("dim", "class_id", "vector").coalesce(1 + asked.count() // (8 * QUERY_BLOCK)).mapInArrow(
        mapper(_blocks, QUERY_BLOCK, low, width, False), block).withColumn("id", F.monotonically_increasing_id()), "query-blocks")
    # One row per query block goes through this window, not the queries.
    numbers = packed.select("id", (F.row_number().over(Window.orderBy("id")) - 1).alias("block"))
    query_blocks = packed.join(numbers, "id").select("block", F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("body").alias("q_body"))
    index = classes.select("dim", "class_id", "vector").mapInArrow(mapper(_blocks, INDEX_BLOCK, low, width, True), block)
    grid = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(0, packed.count() - 1)))))
    met = grid.join(query_blocks, "block").where("dim = q_dim").select("dim", "q_ids", "q_body", "ids", "body")
    spread = met.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = staging.table(spread.mapInArrow(mapper(_scan, low, width, keep), "query_class long, class_id long, lower double, upper double"), "bounds")

    reach = _best(bounds.select("query_class", "lower", "class_id"), "query_class", [F.desc("lower"), F.col("class_id")], keep)
    reach = reach.groupBy("query_class").agg(F.min("lower").alias("reach"), F.count(F.lit(1)).alias("n"))
    candidates = staging.table(
        bounds.join(reach, "query_class").where((F.col("upper") >= F.col("reach")) | (F.col("n") < keep)).select("query_class", "class_id", "upper"), "candidates"
    )
    first = staging.table(_best(candidates, "query_class", [F.desc("upper"), F.col("class_id")], keep), "first")
    read = staging.table(_exact(first, classes), "read")
    certain = read.groupBy("query_class").agg(F.min("score").alias("reach"), F.count(F.lit(1)).alias("n"))
    others = candidates.join(first.select("query_class", "class_id"), ["query_class", "class_id"], "left_anti").join(certain, "query_class").where(
        (F.col("upper") >= F.col("reach")) | (F.col("n") < keep)
    )
    scored = read.unionByName(_exact(others, classes))
    found = (
        asked.join(scored, "query_class").join(classes.select("class_id", "members"), "class_id")
        .select("query_id", "query_row", "score", F.inline("members")).where("row_nr <> query_row")
    )
    best = [F.desc("score"), F.col("vec_id").asc_nulls_last(), F.col("row_nr")]
    order = Window.partitionBy("query_row").orderBy(*best)
    # Thinned by salts first, as copies of a common vector lead to very many rows of a query.
    return _best(found, "query_row", best, k).withColumn("rank", F.row_number().over(order)).select("query_id", "rank", "vec_id", "score")
