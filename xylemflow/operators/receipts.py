"""Receipts: nested documents of a run, and their file entries by category.

A receipt is a few documents of one shape, ``run_id, part, receipt`` with the receipt as VARIANT:
part 0 has the summaries, the others about :data:`PART_ENTRIES` file entries or skipped chunks each,
so that no task holds the list of a large batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from xylemflow.operators.summaries import side_by_side

EXAMPLES = 10
PART_ENTRIES = 1000
ATTEMPTS = "array<struct<parser: string, message: string, line_index: int>>"
FILES = f"array<struct<path: string, file_hash: string, status: string, parser_attempts: {ATTEMPTS}, first_error_line: int>>"
CHUNKS = (
    "array<struct<logger_id: string, file_set_signature: string, anchor_timestamp_local: string, row_count: bigint, reason: string>>"
)

# --- Fixed values: categories, in priority order ------------------------------------------
CATEGORIES = ["accepted", "duplicates", "public", "status", "datatableinfo", "nonutf8", "other"]
# --- End of fixed values ------------------------------------------------------------------


def category(path: Column, status: Column, attempts: Column) -> Column:
    lowered = F.lower(path)
    not_utf8 = F.exists(
        attempts,
        lambda a: (a["parser"] == "utf8") & F.lower(a["message"]).contains("not valid utf-8"),
    )
    result = F.when(F.lower(status) == "parsed", "accepted").when(
        F.lower(status) == "duplicate", "duplicates"
    )
    for word in ("public", "status", "datatableinfo"):
        result = result.when(lowered.contains(word), word)
    return result.when(not_utf8, "nonutf8").otherwise("other")


def receipt_categories(files: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """Per category the number of files and its first paths, empty categories included.

    A first window inside hashed shares of each category keeps only candidate paths, so the
    final ranking of a category reads a bounded number of rows.
    """
    spark = files.sparkSession
    entries = files.select(
        category(F.col("path"), F.col("status"), F.col("parser_attempts")).alias("category"), "path"
    )
    counts = entries.groupBy("category").agg(F.count(F.lit(1)).alias("count"))
    shares = entries.withColumn("_share", F.pmod(F.xxhash64("path"), F.lit(64)))
    in_share = Window.partitionBy("category", "_share").orderBy("path")
    in_category = Window.partitionBy("category").orderBy("path")
    firsts = (
        shares.withColumn("_rank", F.row_number().over(in_share))
        .where(F.col("_rank") <= examples)
        .withColumn("_rank", F.row_number().over(in_category))
        .where(F.col("_rank") <= examples)
        .groupBy("category")
        .agg(F.array_join(F.array_sort(F.collect_list("path")), ",").alias("examples"))
    )
    listed = spark.createDataFrame([(c,) for c in CATEGORIES], "category string")
    return (
        listed.join(counts, "category", "left")
        .join(firsts, "category", "left")
        .select(
            "category",
            F.coalesce("count", F.lit(0)).alias("count"),
            F.coalesce("examples", F.lit("-")).alias("examples"),
        )
    )


def _document(struct: Column) -> Column:
    return F.parse_json(F.to_json(struct)).alias("receipt")


def receipt_head(
    run_id: str,
    pipeline: str,
    status: str,
    counted: DataFrame,
    summary: DataFrame | None = None,
    added: DataFrame | None = None,
    error: str | None = None,
) -> DataFrame:
    """Part 0 of a receipt: one row of all summaries; absent ones are left out of the document."""
    rows = counted.select(F.struct("total", "parsed", "duplicates", "failed").alias("ingestion_summary"))
    run = [F.lit(pipeline).alias("pipeline"), F.lower(F.lit(status)).alias("status"), F.lit(error).cast("string").alias("error")]
    outside = [F.lit(run_id).alias("transaction_id")]
    if summary is not None:
        nested = summary.select(
            F.struct("total_rows", "suspect_rows", "good_rows", "suspect_ratio", "top_reasons").alias("quality_summary"),
            F.struct("top_overrides").alias("provenance_summary"),
            F.struct(
                "logger_count", "sensor_count", F.struct(F.col("timeframe_start").alias("start"), F.col("timeframe_end").alias("end")).alias("timeframe_utc")
            ).alias("record_summary"),
            F.col("total_rows").alias("row_count"), "excluded_rows_no_deployment", "skipped_chunk_count", "skipped_record_count",
        )
        rows = side_by_side(rows, nested)
        run += [F.col(c) for c in nested.columns]
        outside.append(F.struct(F.lit(run_id).alias("output_id")).alias("artifacts"))
    if added is not None:
        counts = added.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat("entity", F.lit("_added")), "count")))).alias("metadata_summary"))
        rows = side_by_side(rows, counts)
        outside.append(F.col("metadata_summary"))
    return rows.select(F.lit(run_id).alias("run_id"), F.lit(0).alias("part"), _document(F.struct(*outside, "ingestion_summary", F.struct(*run).alias("pipeline"))))


def _parts(run_id: str, entries: DataFrame, name: str, key: str, first: int, parts: int) -> DataFrame:
    part = (F.pmod(F.xxhash64(key), F.lit(parts)) + first).cast("int")
    listed = entries.select(part.alias("part"), F.struct(*entries.columns).alias("_entry")).groupBy("part")
    return listed.agg(_document(F.struct(F.collect_list("_entry").alias(name)))).select(F.lit(run_id).alias("run_id"), "part", "receipt")


def file_parts(run_id: str, reports: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """The other parts of a receipt: its file entries and skipped chunks, in bounded documents."""
    count = lambda rows: -(-rows.count() // PART_ENTRIES)
    n = count(reports)
    columns = ["path", "file_hash", "status", "parser_attempts", "first_error_line"]
    documents = _parts(run_id, reports.select(*columns), "files", "path", 1, max(1, n))
    if skipped is None:
        return documents
    names = ["logger_id", "file_set_signature", "anchor_timestamp_local", "row_count", "reason"]
    return documents.unionByName(_parts(run_id, skipped.select(*names), "skipped_chunks", "file_set_signature", 1 + max(1, n), max(1, count(skipped))))


def receipt_files(documents: DataFrame) -> DataFrame:
    """One row per file entry of ``run_id, part, receipt`` documents."""
    return documents.select("run_id", F.inline(F.try_variant_get("receipt", "$.files", FILES)))


def receipt_chunks(documents: DataFrame) -> DataFrame:
    """One row per skipped chunk of the documents."""
    return documents.select("run_id", F.inline(F.try_variant_get("receipt", "$.skipped_chunks", CHUNKS)))


HEAD = (
    "struct<transaction_id: string, ingestion_summary: struct<total: bigint, parsed: bigint, duplicates: bigint, failed: bigint>, "
    "pipeline: struct<pipeline: string, status: string, error: string, row_count: bigint, excluded_rows_no_deployment: bigint>, "
    "metadata_summary: map<string, bigint>>"
)


def receipt_summaries(documents: DataFrame) -> DataFrame:
    """One row per run from the heads of its documents."""
    head = documents.where(F.col("part") == 0).select("run_id", F.try_variant_get("receipt", "$", HEAD).alias("head"))
    return head.select("run_id", "head.*")
