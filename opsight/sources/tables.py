"""Lazy access to the named Parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Tables:
    """``Tables(spark, "/data/sf1").lineitem`` reads ``lineitem.parquet`` lazily.

    Reads are plain ``spark.read.parquet`` scans, so projections and filters of
    the calling query reach the scan (``ReadSchema`` / ``PushedFilters``).
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise KeyError(f"unknown table {name!r}")
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)
