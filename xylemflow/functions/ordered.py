"""Order-dependent operators that stay balanced when one key holds most of the rows.

A plain ``lag`` window puts a whole key into one task. Here the order column is cut into
fixed-width buckets: ``lag`` runs inside ``(key, bucket)``, and the value carried into each
bucket comes from a second, much smaller ``lag`` over one row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from xylemflow.session import cut_lineage


def _same(keys: Sequence[str], null_keys: bool) -> Column:
    """Equality of the keys of ``r`` and ``c``; plain, so that the partitioning is reused."""
    operator = "<=>" if null_keys else "="
    return F.expr(" AND ".join(f"r.{k} {operator} c.{k}" for k in keys))


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    position: Column,
    order: Sequence[str],
    value: str,
    output: str,
    bucket_bits: int = 16,
    null_keys: bool = False,
) -> DataFrame:
    """Add ``output`` = ``value`` of the previous row of the key in ``order``.

    ``position`` is a non-null bigint that never decreases along ``order``; rows are unique in
    ``keys + order``. With ``bucket_bits`` bits per bucket a task sorts at most
    ``2**bucket_bits`` distinct positions of one key, however many rows the key has.
    The first row of a key gets null. Set ``null_keys`` where a key column may be null.
    """
    work = df.withColumn("_bucket", F.shiftright(position, bucket_bits))
    group = [*keys, "_bucket"]
    order_key = F.struct(*[F.col(c) for c in order])

    inside = Window.partitionBy(*group).orderBy(*order)
    rows = work.select(
        "*",
        F.lag(F.struct(F.col(value).alias("v"))).over(inside).alias("_before"),
    )

    tails = work.groupBy(*group).agg(F.max_by(F.struct(F.col(value).alias("v")), order_key).alias("_tail"))
    carried = tails.select(
        *group,
        F.lag("_tail").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("_carried"),
    )
    return rows.alias("r").join(carried.alias("c"), _same(group, null_keys), "left").select(
        *[F.col(f"r.{c}") for c in df.columns],
        F.coalesce("_before", "_carried")["v"].alias(output),
    )


def running_max_before(
    df: DataFrame,
    keys: Sequence[str],
    position: Column,
    order: Sequence[str],
    value: str,
    output: str,
    bucket_bits: int = 36,
    null_keys: bool = False,
) -> DataFrame:
    """Add ``output`` = largest ``value`` among the rows of the key before this one.

    Bucketed like :func:`previous_value`; null for the first row of a key.
    """
    work = df.withColumn("_bucket", F.shiftright(position, bucket_bits))
    group = [*keys, "_bucket"]
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = work.select("*", F.max(value).over(inside).alias("_before"))
    tops = work.groupBy(*group).agg(F.max(value).alias("_top"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(*group, F.max("_top").over(earlier).alias("_carried"))
    return rows.alias("r").join(carried.alias("c"), _same(group, null_keys), "left").select(
        *[F.col(f"r.{c}") for c in df.columns],
        F.greatest("_before", "_carried").alias(output),
    )


def global_index(df: DataFrame, order: Sequence[str], output: str = "row_nr") -> DataFrame:
    """Add the 0-based position of each row in the total order of the frame.

    A range-partitioned sort is checkpointed, so that its partitions are fixed; the index is
    the position inside the partition plus the size of the partitions before it. Only one
    count per partition goes through a single task.
    """
    ordered = cut_lineage(df.orderBy(*order))
    local_bits = 33  # monotonically_increasing_id keeps the in-partition index in 33 bits
    numbered = ordered.withColumn("_id", F.monotonically_increasing_id()).select(
        *[F.col(c) for c in df.columns],
        F.shiftright("_id", local_bits).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << local_bits) - 1)).alias("_local"),
    )
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return numbered.join(offsets, "_part").select(
        *[F.col(c) for c in df.columns],
        (F.col("_offset") + F.col("_local")).alias(output),
    )
