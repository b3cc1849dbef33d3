"""Clean a document table for training: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerstar.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from ledgerstar.llm.common import stored, table
from ledgerstar.llm.queries import vocabulary_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines that three or more of them share stay in one only."""
    return line_dedup.dedup_lines(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, in sequences."""
    return packing.pack(docs, vocabulary_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_each),
    ("decontaminate", drop_leaks),
    ("packing", pack),
]
ORACLE_SQL = None  # a trained model, retrieval and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
