"""File-to-curated-zone ETL job (C17, C18; sinks A6, A7, A11).

ingest -> schema validation -> clean (dedup, trim+lower, null summary,
row hash, metadata) -> quality score -> curated Parquet zone -> JSON report
-> metrics. The cleaned frame is persisted once; the score, the row count
and the write all read that one materialisation.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opsight.functions.scalar import row_hash, strip_ws
from opsight.operators import cleaning as C
from opsight.operators.quality import etl_quality_score
from opsight.sources.files import read_source
from opsight.sources.metrics import publish_metrics
from opsight.sources.sinks import write_report, write_zone


def etl_clean(df: DataFrame, source_file: str | Column, run_ts: dt.datetime,
              hash_columns: Sequence[str] | None = None, hash_width: int = 4,
              keep: Sequence[str] = ()) -> DataFrame:
    """Exact dedup, then trim + lower-case every string column, then a 16-hex
    sha256 row hash of the first ``hash_width`` columns (or ``hash_columns``),
    then ``_loaded_at`` / ``_source_file`` (C17).

    Dedup runs before lower-casing, so rows that differ only in case or
    surrounding space both survive (as in the original). ``source_file`` is a
    literal key or a per-row column; ``keep`` columns pass through unchanged
    (not lower-cased, not hashed, dropped from the output).
    """
    d = df.distinct()
    strings = set(C.string_columns(d)) - set(keep)
    d = d.select(*[F.lower(strip_ws(c)).alias(c) if c in strings else F.col(c) for c in d.columns])
    data_cols = [c for c in d.columns if c not in set(keep)]
    keys = list(hash_columns) if hash_columns else data_cols[:hash_width]
    src = source_file if isinstance(source_file, Column) else F.lit(source_file)
    return d.select(
        *data_cols,
        row_hash(keys).alias("row_hash"),
        F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz").alias("_loaded_at"),
        src.alias("_source_file"),
    )


class EtlJob:
    """One ETL run over one landed file."""

    def __init__(self, spark: SparkSession, source_path: str, zone_root: str, reports_root: str,
                 metrics_path: str | None = None, source_key: str | None = None,
                 run_ts: dt.datetime | None = None, run_id: str | None = None):
        self.spark = spark
        self.source_path = source_path
        self.source_key = source_key or source_path.rstrip("/").split("/")[-1]
        self.zone_root = zone_root
        self.reports_root = reports_root
        self.metrics_path = metrics_path
        self.run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.run_id = run_id or self.run_ts.strftime("%Y%m%d_%H%M%S") + "_" + uuid.uuid4().hex[:6]
        self.report: dict = {"timestamp": self.run_ts.isoformat(), "checks": []}

    def run(self, expected_schema: dict[str, str], schema=None) -> tuple[DataFrame, dict]:
        """Run the job; returns the written partition and the report.

        One pass deduplicates and persists the cleaned rows; source rows and lost values are observed on
        the way, and NULL counts, score, row count and write read the persisted rows.
        """
        raw = read_source(self.spark, self.source_path, schema)
        errors = []
        missing = C.missing_columns(raw, list(expected_schema))
        if missing:
            errors.append(f"Missing columns: {set(missing)}")
        self.report["checks"].append({"check": "schema_validation", "passed": not errors, "errors": errors})
        seen = Observation(f"etl_{uuid.uuid4().hex[:8]}")
        lost = {f"lost_{i}": (c, e) for i, (c, e) in enumerate(C.coercion_exprs(raw, expected_schema, C.DEFAULT_DATE_FORMATS).items())}
        observed = raw.observe(seen, F.count(F.lit(1)).alias("rows"), *[
            F.count_if(C.value_lost(raw, c, e)).alias(k) for k, (c, e) in lost.items()])
        typed, _ = C.coerce_types(observed, expected_schema)
        cleaned = etl_clean(typed, self.source_key, self.run_ts).persist()
        try:
            out_rows = cleaned.count()
            nulls = C.null_counts(cleaned, [c for c in raw.columns if c in cleaned.columns])
            source_rows = seen.get["rows"]
            self.report["source_rows"] = source_rows
            self.report["checks"].append({
                "check": "cleaning",
                "duplicates_removed": source_rows - out_rows,
                "null_summary": {k: v for k, v in nulls.items() if v > 0},
                "coercion_losses": {c: seen.get[k] for k, (c, _) in lost.items() if seen.get[k]},
                "output_rows": out_rows,
            })
            score_row = etl_quality_score(cleaned).first()
            self.report["quality_score"] = score_row["quality_score"]
            self.report["completeness"] = score_row["completeness"]
            self.report["uniqueness"] = score_row["uniqueness"]
            self.report["output_path"] = write_zone(cleaned, self.zone_root, self.run_id)
        finally:
            cleaned.unpersist()
        self.report["final_rows"] = out_rows
        write_report(self.spark, self.report, f"{self.reports_root.rstrip('/')}/report_{self.run_id}")
        if self.metrics_path:
            publish_metrics(self.spark, self.metrics_path, [
                ("QualityScore", score_row["quality_score"] or 0.0, "None"),
                ("RowsProcessed", out_rows, "Count"),
            ])
        return self.spark.read.parquet(self.report["output_path"]), self.report
