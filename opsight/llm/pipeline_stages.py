"""The stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``, each calling one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opsight.llm import line_dedup, mixing, ngram_join, quality_rules, sentencepiece_bpe


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules, learned from ``labels``, reject go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines stay once; documents that lose all their lines go."""
    return line_dedup.without_repeated_lines(docs)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of n-gram Jaccard links stays, the one with the smallest doc_id."""
    return ngram_join.keep_one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: for each pass over a document the part of it that the sources' targets take."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids and digests of the ids and of the decoded text, for each row of the mix."""
    return sentencepiece_bpe.token_report(docs)
