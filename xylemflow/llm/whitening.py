"""Embedding whitening by FEAST contour integration.

1. *Fit.* Sums and the covariance are added up over all vectors: tasks send one row per dimension,
   not vectors. The covariance is centred before multiplying.
2. *Intervals.* The covariance is reduced to tridiagonal form once; by Sylvester's law the number of
   negative pivots of a shifted one counts the eigenvalues below the shift. Those counts cut the
   upper spectrum into intervals of at most :data:`PER_INTERVAL` eigenvalues, with borders in the
   middle of gaps.
3. *Contours.* Each interval is a task of its own: a Gauss-Legendre quadrature of complex shifted
   solves ``(zI - V) Q = Y`` on a circle through its borders projects a block onto the interval's
   eigenvectors, Rayleigh-Ritz extracts them, until the residuals stay at rounding level.
4. *Check.* An interval must have given as many eigenvalues as the inertia counts say; else the run
   fails instead of returning fewer components.
5. *Whitening.* Vectors are projected in blocks; one more pass adds up the whitened covariance.

Defined results: vectors that are null, empty or hold null or non-finite components are dropped, and
so are those of another length than the most common one (the longer of equally common ones); fewer
dimensions give fewer components; eigenvalues at rounding level of the largest (a constant or
repeated dimension, or equal vectors only) cannot be whitened and give no component, so that equal
vectors alone give no rows; ties of eigenvalues are numbered in any order, the same for all rows;
``x`` saturates at the bounds of :data:`MOST`, and a deviation beyond 64 bits is null; repeated rows
and null ids are rows like others; other columns play no part. The covariance of ``d`` dimensions is
sent to the tasks and its spectrum is computed there; ``d`` is limited to :data:`MOST_DIMENSIONS`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xylemflow.llm.hashing import binary_values
from xylemflow.llm.postings import mapper
from xylemflow.llm.staging import Staging

SCALE, SHIFT, MOST = 64, 1_000_000, 1 << 61
COMPONENTS = 32
#: The covariance matrix has 8 bytes times its square.
MOST_DIMENSIONS = 4096
PER_INTERVAL, NODES, ROUNDS = 8, 16, 40
#: Eigenvalues below this share of the largest are rounding, in units of the dimension's epsilon.
ROUNDING = 16 * np.finfo(float).eps
SEED = 11

FITTED = "row_nr long, vec_id long, dim int, x binary"
SUMS = "dim_nr int, other int, total double"


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``row_nr, vec_id, embedding`` to the integer vectors of usable rows."""
    for batch in batches:
        at, dims, cells = [], [], []
        for i, values in enumerate(batch.column(2)):
            if not values.is_valid or not len(values.values) or values.values.null_count:
                continue
            c = np.asarray(values.values.to_numpy(zero_copy_only=False), np.float64)
            if np.isfinite(c).all():
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(SCALE * c), -MOST, MOST).astype("<i8") + SHIFT
                at.append(i)
                dims.append(len(x))
                cells.append(x.tobytes())
        at = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(dims, pa.int32()), pa.array(cells, pa.binary())],
            names=["row_nr", "vec_id", "dim", "x"],
        )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return binary_values(column, "<i8")[0].reshape(-1, dim)


def _integer_sums(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """One row per task and dimension: the exact sum, in two halves that add up without overflow."""
    high, low = np.zeros(dim, object), np.zeros(dim, object)
    for batch in batches:
        x = _matrix(batch.column(0), dim)
        high += (x >> 31).sum(axis=0).astype(object)
        low += (x & 0x7FFFFFFF).sum(axis=0).astype(object)
    totals = [str((int(h) << 31) + int(v)) for h, v in zip(high, low)]
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(totals, pa.string())], names=["dim_nr", "total"])


def _triangle(matrix: np.ndarray) -> pa.RecordBatch:
    i, j = np.triu_indices(len(matrix))
    return pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(matrix[i, j])], names=["dim_nr", "other", "total"])


def _products(batches: Iterator[pa.RecordBatch], dim: int, mean: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row per task and pair of dimensions: the sum of products of centred components."""
    total = np.zeros((dim, dim))
    for batch in batches:
        y = _centred(_matrix(batch.column(0), dim), mean)
        total += y.T @ y
    yield _triangle(total)


def _centred(x: np.ndarray, mean: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """``x - S/n`` as doubles; the mean comes as a whole and a fractional part, so nothing cancels."""
    whole, rest = mean
    return (x - whole).astype(np.float64) - rest


def _whitened_products(batches: Iterator[pa.RecordBatch], dim: int, mean, axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of products of whitened components, with their plain sums in a last row and column."""
    total = np.zeros((axes.shape[1] + 1,) * 2)
    for batch in batches:
        w = _centred(_matrix(batch.column(0), dim), mean) @ axes
        w = np.hstack([w, np.ones((len(w), 1))])
        total += w.T @ w
    yield _triangle(total)


def _added(spark: SparkSession, parts: DataFrame, size: int) -> np.ndarray:
    """A symmetric matrix from the tasks' rows; the driver gets its ``size * (size + 1) / 2`` entries."""
    total = np.zeros((size, size))
    rows = parts.groupBy("dim_nr", "other").agg(F.sum("total").alias("total")).toArrow()
    if rows.num_rows:
        i, j, v = (rows[c].to_numpy() for c in ("dim_nr", "other", "total"))
        total[i, j] = v
        total[j, i] = v
    return total


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and subdiagonal of an orthogonally similar matrix, by Householder reflections."""
    a = np.array(matrix, np.float64)
    n = len(a)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if length == 0:
            continue
        v[0] += np.copysign(length, v[0])
        v /= np.linalg.norm(v)
        a[k + 1 :, k:] -= 2 * np.outer(v, v @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def inertia(diagonal: np.ndarray, beside: np.ndarray, shift: float) -> int:
    """The number of eigenvalues below the shift: negative pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny
    scale = max(float(np.abs(beside).max(initial=0)), float(np.abs(diagonal).max(initial=0)), tiny)
    negative, pivot = 0, 1.0
    for k in range(len(diagonal)):
        pivot = diagonal[k] - shift - (beside[k - 1] ** 2 / pivot if k else 0.0)
        if abs(pivot) < np.finfo(float).eps * np.finfo(float).eps * scale:
            pivot = -np.finfo(float).eps * np.finfo(float).eps * scale
        negative += pivot < 0
    return int(negative)


def _border(form, low: float, high: float, above: int) -> tuple[float, int]:
    """A shift in the middle of a gap with at least ``above`` eigenvalues over it, as few as possible.

    ``low`` has at least ``above`` over it and ``high`` has fewer; the result lies in the gap under
    the ``above``-th largest eigenvalue, or under its whole cluster.
    """
    n = len(form[0])
    over = lambda shift: n - inertia(*form, shift)
    bottom, a, b = low, low, high
    for _ in range(200):
        middle = (a + b) / 2
        if middle in (a, b):
            break
        a, b = (middle, b) if over(middle) >= above else (a, middle)
    # ``a`` is just under the eigenvalue; go on down to the next lower one for the gap's width.
    count = over(a)
    c, d = bottom, a
    if over(bottom) == count:
        return bottom, count
    for _ in range(200):
        middle = (c + d) / 2
        if middle in (c, d):
            break
        c, d = (c, middle) if over(middle) == count else (middle, d)
    return (a + d) / 2, count


def spectrum_intervals(matrix: np.ndarray, wanted: int, floor: float) -> list[tuple[float, float, int]]:
    """``low, high, count`` from the top, until ``wanted`` eigenvalues above ``floor`` are in."""
    form = tridiagonal(matrix)
    reach = np.abs(matrix).sum(axis=1).max()
    n, high = len(matrix), reach * (1 + 1e-6) + np.finfo(float).tiny
    wanted = min(wanted, n - inertia(*form, floor))
    out, done = [], 0
    while done < wanted:
        low, count = _border(form, floor, high, min(done + PER_INTERVAL, wanted))
        out.append((float(low), float(high), count - done))
        done, high = count, low
    return out


def feast(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in ``(low, high]`` and their unit vectors, by contour projection.

    The block is wider than the count, so that eigenvalues just outside do not slow it down; it is
    projected again until the residuals no longer fall.
    """
    n = len(matrix)
    size = min(n, 2 * count + 8)
    middle, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    # The contour's upper half; the lower one gives the conjugate.
    angles = np.pi * (1 - nodes) / 2
    shifts = middle + radius * np.exp(1j * angles)
    factors = weights * radius * np.exp(1j * angles) / 2
    inverses = [np.linalg.inv(z * np.eye(n) - matrix) for z in shifts] if n <= 512 else None
    block = np.random.default_rng(SEED).standard_normal((n, size))
    best = None
    for _ in range(ROUNDS):
        projected = np.zeros((n, block.shape[1]))
        for k, (z, factor) in enumerate(zip(shifts, factors)):
            solved = inverses[k] @ block if inverses else np.linalg.solve(z * np.eye(n) - matrix, block)
            projected += (factor * solved).real
        q, r, _ = np.linalg.svd(projected, full_matrices=False)
        q = q[:, r > r[0] * n * np.finfo(float).eps]
        values, inner = np.linalg.eigh(q.T @ matrix @ q)
        block = q @ inner
        inside = (values > low) & (values <= high)
        found, vectors = values[inside], block[:, inside]
        vectors = vectors / np.linalg.norm(vectors, axis=0)
        residual = np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max(initial=0) if len(found) == count else np.inf
        if best is not None and len(best[1]) == count and residual >= best[0] / 2:
            break
        if best is None or residual < best[0]:
            best = (residual, found, vectors)
    return best[1], best[2]


def _solved(batches: Iterator[pa.RecordBatch], matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, count in zip(*(batch.column(i).to_pylist() for i in range(3))):
            values, vectors = feast(matrix, low, high, count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([low] * len(values), pa.float64()), pa.array(values), pa.array([v.tobytes() for v in vectors.T], pa.binary())],
                names=["low", "value", "vector"],
            )


def principal_axes(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns; one task per interval."""
    n = len(matrix)
    floor = max(float(np.trace(matrix)), 0.0) * ROUNDING * n
    if floor == 0:
        return np.zeros(0), np.zeros((n, 0))
    intervals = spectrum_intervals(matrix, wanted, floor)
    if not intervals:
        return np.zeros(0), np.zeros((n, 0))
    asked = spark.createDataFrame(intervals, "low double, high double, count int").repartition(len(intervals))
    rows = asked.mapInArrow(mapper(_solved, matrix), "low double, value double, vector binary").collect()
    for low, high, count in intervals:
        found = sum(row.low == low for row in rows)
        if found != count:
            raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, {found} were found")
    rows = sorted(rows, key=lambda row: -row.value)[:wanted]
    return np.array([row.value for row in rows]), np.stack([np.frombuffer(row.vector) for row in rows], axis=1)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """``sum((n * x - S) ** 2)``, exact, or null beyond 64 bits."""
    dim = len(sums)
    reach = max(abs(int(x.min())), abs(int(x.max()))) * n + max(map(abs, sums)) if len(x) else 0
    if reach < 1 << 62:
        apart = n * x - np.array(sums, np.int64)
        most = int(np.abs(apart).max(initial=0))
        if most * most * dim < 1 << 63:
            return (apart * apart).sum(axis=1).tolist()
        apart = apart.astype(object)
    else:
        apart = n * x.astype(object) - np.array(sums, object)
    exact = (apart * apart).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def _components(batches: Iterator[pa.RecordBatch], dim: int, n: int, sums: list[int], mean, axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    k = axes.shape[1]
    for batch in batches:
        x = _matrix(batch.column(1), dim)
        whitened = _centred(x, mean) @ axes
        at = pa.array(np.repeat(np.arange(len(x)), k))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(_deviations(x, n, sums), pa.int64()).take(at), pa.array(whitened.ravel()),
            ],
            names=["vec_id", "component", "deviation", "whitened"],
        )


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Rows of :data:`RESULT`: each usable vector's whitened components, fitted on all of them.

    ``embeddings`` has ``vec_id`` and the array ``embedding``.
    """
    spark = embeddings.sparkSession
    staging = Staging(spark, "whitening")
    source = embeddings.select(F.monotonically_increasing_id().alias("row_nr"), F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    fitted = staging.table(source.mapInArrow(_integers, FITTED), "integers")
    common = fitted.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if common is None:
        return spark.createDataFrame([], RESULT)
    dim, n = common.dim, common.n
    if dim > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {dim} dimensions: the covariance is limited to {MOST_DIMENSIONS}")
    fitted = fitted.where(F.col("dim") == dim)
    x = fitted.select("x")
    totals = x.mapInArrow(mapper(_integer_sums, dim), "dim_nr int, total string")
    totals = totals.groupBy("dim_nr").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    sums = [int(row.total) for row in sorted(totals, key=lambda row: row.dim_nr)]
    whole = [s // n for s in sums]
    mean = (np.array(whole, np.int64), np.array([(s - w * n) / n for s, w in zip(sums, whole)]))
    covariance = _added(spark, x.mapInArrow(mapper(_products, dim, mean), SUMS), dim) / n
    values, vectors = principal_axes(spark, covariance, components)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    axes = vectors / np.sqrt(values)
    moments = _added(spark, x.mapInArrow(mapper(_whitened_products, dim, mean, axes), SUMS), len(values) + 1) / n
    spread = moments[:-1, :-1] - np.outer(moments[-1, :-1], moments[-1, :-1])
    error = float(np.abs(spread - np.eye(len(values))).max())
    explained = F.element_at(F.array(*[F.lit(float(v)) for v in values / np.trace(covariance)]), F.col("component"))
    rows = fitted.select("vec_id", "x").mapInArrow(
        mapper(_components, dim, n, sums, mean, axes), "vec_id long, component int, deviation long, whitened double"
    )
    return rows.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error")
    )
