"""The corpus pipeline: stages that each read what the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sectorloom.llm import bpe, decontaminate, lang_id, near_dup, quality
from sectorloom.llm.common import materialised, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier selects: well written and not toxic."""
    return quality.select(docs, table(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a score of at least 0.1; texts without letters go."""
    return lang_id.select(docs, least=0.1)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of every near-duplicate class."""
    return near_dup.deduplicated(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document that is left, and the bytes decoded from them."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("benchmark", no_benchmark),
    ("byte_pairs", encoded),
]

# Models fitted on the labels decide which documents stay, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; the result of each is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
