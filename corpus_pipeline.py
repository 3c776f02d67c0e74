"""From raw documents to a training mix: stages applied one after another to the whole corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from auditflow.llm import decontaminate, language_id, line_dedup, mixing, simhash
from auditflow.llm.common import table
from auditflow.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Documents whose language is less sure than this are rejected.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language stay; those without letters or with a low score go."""
    return language_id.keep_identified(docs, LEAST_SCORE)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go, and documents that lose all their lines with words.

    ``n_chars`` follows the text that is left.
    """
    return line_dedup.without_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, also where one of its repeated values was changed."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: ``doc_id, source, size, source_size, target, taken``."""
    return mixing.mixed(spark, docs, sf_dir)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("source_mixing", mix_sources),
]

# A fitted model and 64-bit hashes are not expressible in SQL; tests check the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again as the documents of the next."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"stage-{name}")
    return docs
