"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Stages: quality rules (rejected documents go), line dedup, n-gram Jaccard join (one document of each
group stays), mixing to target weights, SentencePiece encoding and decoding. Every stage works on all
rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opsight.llm.common import shared_table
from opsight.llm.pipeline_stages import deduplicate_lines, encode, join_near_copies, keep_quality, mix_sources

STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", deduplicate_lines),
    ("ngram_jaccard_join", join_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# SimHash, trained rules and merge tables have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``; the result of the last one."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return docs
