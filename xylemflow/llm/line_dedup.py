"""Removal of repeated multi-line chunks with content-defined borders.

A line's hash is taken from its MD5 digest, and a rolling hash over the hashes of
:data:`ROLL` neighbouring lines ends a chunk where it is 0 modulo :data:`MODULUS`: borders depend on
the lines around them only, so an insertion elsewhere does not move them. Chunks of two lines or
more that agree in their line hashes are compared byte by byte with the first of them, by
``doc_id`` and place, and removed where they are equal to it.

DataFrame functions only. Hashes alone are grouped; texts of repeated chunks only are compared.

Defined results: a null text is one empty line; lines end at line feeds; rows that repeat a
``doc_id`` are told apart, the first of equal rows keeps its chunks; a null ``doc_id`` ranks first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from xylemflow.llm.staging import Staging

ROLL, FACTOR, MODULUS, LEAST_LINES = 2, 31, 4, 2


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 12), 16, 10).cast("long")


def chunks(lines: DataFrame) -> DataFrame:
    """``row_nr, doc_id, chunk, first_line, n_lines, key`` of ``row_nr, doc_id, line_nr, h`` rows."""
    order = Window.partitionBy("row_nr").orderBy("line_nr")
    rolled = sum((F.coalesce(F.lag("h", k).over(order), F.lit(0)) % MODULUS * FACTOR**k for k in range(1, ROLL)), F.col("h") % MODULUS)
    marked = lines.withColumn("last", (rolled % MODULUS == 0).cast("int"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    numbered = marked.withColumn("chunk", F.coalesce(F.sum("last").over(before), F.lit(0)))
    return numbered.groupBy("row_nr", "doc_id", "chunk").agg(
        F.min("line_nr").alias("first_line"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sha2(F.array_join(F.array_sort(F.collect_list(F.struct("line_nr", "h")))["h"].cast("array<string>"), ","), 256).alias("key"),
    )


def remove_repeated_chunks(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, n_chunks, kept`` of every row of ``docs`` (``doc_id``, ``text``).

    ``docs`` must be a plain scan.
    """
    staging = Staging(docs.sparkSession, "line-dedup")
    source = docs.select(
        F.monotonically_increasing_id().alias("row_nr"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    lines = source.select("row_nr", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_nr", "line")).select(
        "row_nr", "doc_id", "line_nr", line_hash(F.col("line")).alias("h")
    )
    found = staging.table(chunks(lines).where(F.col("n_lines") >= LEAST_LINES), "chunks")
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row_nr", "chunk")
    groups = staging.table(
        found.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"), "groups"
    )
    repeated = found.join(groups, "key").select(
        "row_nr", "key", "chunk", "first_line", "n_lines",
        ((F.col("row_nr") == F.col("first.row_nr")) & (F.col("chunk") == F.col("first.chunk"))).alias("is_first"),
    )
    wanted = repeated.groupBy("row_nr").agg(F.collect_list(F.struct("key", "chunk", "first_line", "n_lines", "is_first")).alias("wanted"))
    cut = F.array_join(F.slice("all_lines", F.col("w.first_line") + 1, F.col("w.n_lines").cast("int")), "\n")
    texts = staging.table(
        source.join(wanted, "row_nr")
        .select("row_nr", F.split("text", "\n", -1).alias("all_lines"), F.explode("wanted").alias("w"))
        .select("row_nr", "w.key", "w.chunk", "w.first_line", "w.n_lines", "w.is_first", cut.alias("chunk_text")),
        "chunk-texts",
    )
    first = texts.where("is_first").select("key", F.col("chunk_text").alias("first_text"))
    equal = texts.where("NOT is_first").join(first, "key").where("chunk_text = first_text")
    removed = staging.table(
        equal.groupBy("row_nr").agg(
            F.array_sort(F.collect_list(F.struct("first_line", "n_lines"))).alias("gone"), F.sum("n_lines").alias("n_removed"), F.count(F.lit(1)).alias("n_chunks")
        ),
        "removed",
    )
    staging.drop(texts)
    gone = F.flatten(F.transform("gone", lambda g: F.sequence(g["first_line"].cast("int"), (g["first_line"] + g["n_lines"] - 1).cast("int"))))
    kept_lines = F.transform(
        F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), gone), lambda i: F.get("all_lines", i)
    )
    joined = source.join(removed, "row_nr", "left").select("doc_id", "text", F.split("text", "\n", -1).alias("all_lines"), "gone", "n_removed", "n_chunks")
    return joined.withColumn("n_lines", F.size("all_lines")).select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_chunks", F.lit(0)).cast("long").alias("n_chunks"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept_lines, "\n")).alias("kept"),
    )
