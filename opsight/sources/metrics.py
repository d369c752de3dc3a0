"""Pipeline metrics appended to a metrics table."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Metric names the ETL publishes.
METRIC_NAMES = ("FilesProcessed", "FileSizeBytes", "ProcessingErrors", "QualityScore", "RowsProcessed")

METRICS_SCHEMA = ("ts timestamp_ntz, namespace string, metric string, value double, unit string, "
                  "environment string, pipeline string")


def metrics_frame(spark: SparkSession, metrics: Iterable[tuple[str, float, str]],
                  namespace: str = "AnalyticsPipeline", environment: str = "production",
                  pipeline: str = "analytics-etl", ts: dt.datetime | None = None) -> DataFrame:
    now = ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(now, namespace, name, float(value), unit, environment, pipeline) for name, value, unit in metrics]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def publish_metrics(spark: SparkSession, table_path: str, metrics: Iterable[tuple[str, float, str]],
                    **kw) -> bool:
    """Append metric rows to the Parquet metrics table; a failure only warns."""
    try:
        metrics_frame(spark, metrics, **kw).coalesce(1).write.mode("append").parquet(table_path)
        return True
    except Exception as exc:  # noqa: BLE001
        log.warning("metric publish failed: %s", exc)
        return False
