"""Registered queries of this subpackage and, where SQL can say it, their counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from xylemflow.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return build(spark, sf_dir)

        QUERIES[name] = shipped
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query(
    "op10_exact_dedup",
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
      doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY text)""",
)
def _exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xylemflow.llm.exact_dedup import copy_groups

    return copy_groups(documents(spark, sf_dir)).drop("row_nr")


@query("op4_near_dedup")
def _near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xylemflow.llm.near_dedup import near_components

    return near_components(documents(spark, sf_dir))


@query("op9_mixing")
def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xylemflow.llm.mixing import mix_documents

    return mix_documents(documents(spark, sf_dir)).drop("row_nr")


@query("op6_packing")
def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from xylemflow.llm.packing import pack_documents

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op3_language_id")
def _language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from xylemflow.llm.language_id import held_out, predict_languages

    found = predict_languages(documents(spark, sf_dir))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query(
    "op5_topk_search",
    """
    WITH usable AS (
      SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
      FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5""",
)
def _topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xylemflow.llm.topk_search import top_k

    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op8_substring_dedup")
def _substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xylemflow.llm.substring_dedup import remove_repeats

    return remove_repeats(documents(spark, sf_dir)).drop("kept")


@query("op2_private_data")
def _private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xylemflow.llm.private_data import digests, find_private_data

    return digests(find_private_data(documents(spark, sf_dir)))


@query(
    "op7_line_dedup",
    """
    WITH line AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_nr FROM documents),
    hashed AS (SELECT *, CAST('0x' || substring(md5(line), 1, 12) AS BIGINT) AS h FROM line),
    marked AS (
      SELECT *, CASE WHEN (h % 4 + coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY line_nr), 0) % 4 * 31) % 4 = 0 THEN 1 ELSE 0 END AS last
      FROM hashed),
    numbered AS (
      SELECT *, coalesce(sum(last) OVER (PARTITION BY doc_id ORDER BY line_nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
      FROM marked),
    chunks AS (
      SELECT doc_id, chunk, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY line_nr) AS chunk_text FROM numbered GROUP BY doc_id, chunk),
    placed AS (
      SELECT *, n_lines >= 2 AND row_number() OVER (PARTITION BY n_lines >= 2, chunk_text ORDER BY doc_id, chunk) > 1 AS gone FROM chunks)
    SELECT doc_id, CAST(sum(n_lines) AS BIGINT) AS n_lines, CAST(coalesce(sum(n_lines) FILTER (gone), 0) AS BIGINT) AS n_removed,
      count(*) FILTER (gone) AS n_chunks,
      sha256(coalesce(string_agg(chunk_text, chr(10) ORDER BY chunk) FILTER (NOT gone), '')) AS kept_sha256
    FROM placed GROUP BY doc_id""",
)
def _line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from xylemflow.llm.line_dedup import remove_repeated_chunks

    return remove_repeated_chunks(documents(spark, sf_dir)).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query("op1_license_scan")
def _license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xylemflow.llm.licenses import scan_licenses

    return scan_licenses(documents(spark, sf_dir))


@query(
    "op13_lexical_search",
    r"""
    WITH found AS (
      SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term),
    doc AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
    total AS (SELECT count(*) AS all_n, CAST(sum(n) AS BIGINT) AS all_l FROM doc),
    weight AS (
      SELECT term, CAST(floor(1000 * ln(CAST(2 * all_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM tf, total GROUP BY term, all_n),
    asked AS (
      SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    scored AS (
      SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * all_n) // all_l))))) AS BIGINT) AS score
      FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN doc USING (doc_id), total GROUP BY item_id, doc_id)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10""",
)
def _lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xylemflow.llm.lexical_search import search

    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query(
    "op12_embedding_dedup",
    """
    WITH RECURSIVE usable AS (
      SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
    link AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
    reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
    least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
    counted AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN least USING (vec_id) LEFT JOIN counted USING (vec_id)""",
)
def _embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xylemflow.llm.embedding_dedup import near_copies

    return near_copies(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op11_whitening")
def _whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xylemflow.llm.whitening import whiten

    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
