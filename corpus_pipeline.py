"""A corpus through five stages of the llm operators, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwatch.llm.common import table
from shelfwatch.llm.decontaminate import drop_contaminated
from shelfwatch.llm.exact_dedup import drop_copies
from shelfwatch.llm.language_id import drop_unidentified
from shelfwatch.llm.mixing import mixed_documents
from shelfwatch.llm.near_join import drop_near
from shelfwatch.session import materialise


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in no language (NULL text, no letter) go."""
    return drop_unidentified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents with the same text the one with the largest id stays."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more the one with the largest id stays."""
    return drop_near(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that share a window of words with a benchmark item go."""
    return drop_contaminated(docs, table(spark, folder, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix of sources, one row per copy taken, with its number in ``copy``."""
    return mixed_documents(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("decontamination", benchmark_leaks),
    ("mixing", source_mix),
]

ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of ``folder``."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, folder), name)
    return docs
