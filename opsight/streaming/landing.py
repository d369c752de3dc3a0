"""Incremental ETL over a landing folder (A5: the per-new-file trigger).

A Structured Streaming file source lists new files of any kind as (path, size) without reading them
(the checkpoint remembers them), ``trigger(availableNow=True)`` runs all pending files and stops. In each
batch the gate (A4) splits the files: rejected ones go to a table with their reason, accepted ones are
read with the expected schema and run through the ETL. An unreadable accepted file counts a processing
error and fails the batch, so it is neither skipped nor forgotten. Output paths carry the batch id and
are overwritten, so a replayed batch replaces its own output (``foreachBatch`` is at-least-once).
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from opsight.operators import cleaning as C
from opsight.operators.quality import etl_quality_score
from opsight.plans.etl import etl_clean
from opsight.sources.files import gated, list_files, read_files
from opsight.sources.metrics import publish_metrics
from opsight.sources.sinks import write_report

log = logging.getLogger(__name__)


def landing_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of ``landing_dir`` as ``(path, length)``; the content is not read."""
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing_dir).select("path", "length")


def make_batch_etl(zone_root: str, expected_schema: dict[str, str], schema: T.StructType,
                   metrics_path: str | None = None, rejected_path: str | None = None, reports_root: str | None = None,
                   landing_dir: str | None = None):
    """A ``foreachBatch`` function: gate, read, validate, clean, score, write, report, publish metrics.

    Without ``rejected_path`` the rejected files are listed under ``<zone_root>_rejected``. Spark's stream
    leaves empty files out, so each batch lists those that ``landing_dir`` holds at that time as well.
    """
    zone = zone_root.rstrip("/")
    rejects = (rejected_path or f"{zone}_rejected").rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        out = None
        try:
            if landing_dir:
                batch = batch.unionByName(list_files(spark, landing_dir).filter("length = 0"))
            files = gated(batch).persist()  # a row for each file
            files.filter("not accepted").write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
            paths = [r["path"] for r in files.filter("accepted").select("path").toLocalIterator()]
            total = files.filter("accepted").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
            files.unpersist()
            if not paths:
                return
            typed, _ = C.coerce_types(read_files(spark, paths, schema), expected_schema)
            run_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            out = etl_clean(typed, F.col("_file_name"), run_ts, keep=["_file_name"]).persist()
            rows = out.count()
            score = etl_quality_score(out).first()
            out.write.mode("overwrite").parquet(f"{zone}/batch_id={batch_id}")
            if reports_root:
                write_report(spark, {"batch_id": batch_id, "files": total["n"], "final_rows": rows, "quality_score": score["quality_score"],
                                     "completeness": score["completeness"], "uniqueness": score["uniqueness"]},
                             f"{reports_root.rstrip('/')}/report_batch_{batch_id}")
            if metrics_path:
                publish_metrics(spark, metrics_path, [
                    ("FilesProcessed", total["n"], "Count"), ("FileSizeBytes", total["bytes"], "Bytes"),
                    ("QualityScore", score["quality_score"] or 0.0, "None"), ("RowsProcessed", rows, "Count")])
        except Exception:
            if metrics_path:
                publish_metrics(spark, metrics_path, [("ProcessingErrors", 1, "Count")])
            raise
        finally:
            if out is not None:
                out.unpersist()

    return run


def run_landing_etl(spark: SparkSession, landing_dir: str, schema: T.StructType, zone_root: str,
                    checkpoint: str, expected_schema: dict[str, str], metrics_path: str | None = None,
                    rejected_path: str | None = None, reports_root: str | None = None,
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Process every file not yet seen in ``landing_dir`` and stop (availableNow)."""
    q = (landing_stream(spark, landing_dir, max_files_per_trigger).writeStream
         .foreachBatch(make_batch_etl(zone_root, expected_schema, schema, metrics_path, rejected_path, reports_root,
                                      landing_dir))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q
