"""The corpus pipeline: five stages over ``documents``, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaarlens.llm import bpe, decontam, line_dedup, minhash, quality
from bazaarlens.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; the text and its length change."""
    return line_dedup.without_repeats(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return minhash.one_per_class(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.digests(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("encoding", encoding_stage),
]

# The likelihood ratio, the signatures, the alignment and the encoding have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the whole table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
