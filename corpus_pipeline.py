"""A training corpus from raw documents: known languages, no copies, mixed sources, packed sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from xylemflow.llm.exact_dedup import drop_copies
from xylemflow.llm.language_id import keep_known_languages
from xylemflow.llm.mixing import mixed_texts
from xylemflow.llm.near_dedup import drop_near_copies
from xylemflow.llm.packing import pack_documents
from xylemflow.llm.staging import Staging


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known_languages(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_texts(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: The stages hold trained models and graph iterations, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    staging = Staging(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
