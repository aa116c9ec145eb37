"""Connected components by alternating star contraction, with reliable staging in each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.llm.staging import Staging


def _contracted(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One star operation: neighbours of a node are hung on its smallest neighbour.

    ``edges`` has ``a > b``. Large stars look at all neighbours and move the larger ones, small
    stars look at the smaller neighbours and move those and the node itself. Only minima are
    aggregated, so a node with very many neighbours costs one row per task before the shuffle,
    and AQE may split it in the join.
    """
    if both_ways:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges
    least = around.groupBy("a").agg(F.min("b").alias("_m"))
    if both_ways:
        least = least.select("a", F.least("a", "_m").alias("_m"))
        moved = around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        moved = (
            around.join(least, "a").where("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
            .unionByName(least.select("a", F.col("_m").alias("b")))
        )
    return moved.where("a <> b").distinct()


def connected_components(edges: DataFrame, staging: Staging) -> DataFrame:
    """``node, component`` (smallest reachable node) of every node of the links ``a, b``."""
    current = staging.table(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = None
    while True:
        following = staging.table(_contracted(_contracted(current, True), False), "stars")
        staging.drop(current)
        current = following
        seen = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    roots = current.select(F.col("b").alias("node")).distinct()
    return staging.table(
        current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component"))),
        "components",
    )
