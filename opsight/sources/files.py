"""File sources: format choice by suffix (A1-A3) and the input file gate (A4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File suffixes the landing gate accepts.
ACCEPTED_SUFFIXES = (".csv", ".parquet")
# Rejection reasons of the gate.
REASON_UNSUPPORTED = "Unsupported file type"
REASON_EMPTY = "Empty file"


def read_source(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                corrupt_column: str | None = None) -> DataFrame:
    """Read a CSV or Parquet source chosen by the path suffix (A1-A3).

    CSV is read with a header and ``PERMISSIVE`` mode; pass ``schema`` in
    production (inference costs a full extra pass over the data). With
    ``corrupt_column`` unparsable lines land in that column; without it a line
    that does not fit the schema fails the read (``FAILFAST``), so no value
    silently becomes NULL. Excel is not a Spark source: convert it upstream.
    """
    lower = path.lower().rstrip("/")
    if lower.endswith(".csv"):
        lenient = corrupt_column is not None or schema is None
        reader = spark.read.option("header", True).option("mode", "PERMISSIVE" if lenient else "FAILFAST")
        if schema is not None:
            if corrupt_column:
                schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
                schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType())])
                reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
            reader = reader.schema(schema)
        else:
            reader = reader.option("inferSchema", True)
        return reader.csv(path)
    if lower.endswith(".parquet"):
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(path)
    if lower.endswith(".xlsx"):
        raise ValueError(f"Unsupported format: {path} (Excel has no Spark reader; convert to CSV or Parquet)")
    raise ValueError(f"Unsupported format: {path}")


def gated(files: DataFrame, suffixes: Sequence[str] = ACCEPTED_SUFFIXES) -> DataFrame:
    """The gate over ``files(path, length)``: ``path, size, accepted, reason, source``.

    A file is accepted when its suffix is allowed and it is not empty; ``source`` is the path of an
    accepted file, NULL otherwise.
    """
    lower = F.lower(F.col("path"))
    ok_suffix = F.lit(False)
    for s in suffixes:
        ok_suffix = ok_suffix | lower.endswith(s)
    reason = (F.when(~ok_suffix, F.lit(REASON_UNSUPPORTED))
              .when(F.col("length") == 0, F.lit(REASON_EMPTY)))
    return files.select(
        F.col("path"),
        F.col("length").alias("size"),
        reason.isNull().alias("accepted"),
        reason.alias("reason"),
        F.when(reason.isNull(), F.col("path")).alias("source"),
    )


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, length)`` of all files under ``folder``, from the file system's listing.

    Spark's own scans leave empty files out, so the gate would not see them. Hidden files (``_``, ``.``)
    are left out, as Spark does.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    rows = []
    while found.hasNext():
        status = found.next()
        if not status.getPath().getName().startswith(("_", ".")):
            rows.append((status.getPath().toString(), status.getLen()))
    return spark.createDataFrame(rows, "path string, length long")


def gate_files(spark: SparkSession, folder: str, suffixes: Sequence[str] = ACCEPTED_SUFFIXES) -> DataFrame:
    """The gate over all files under ``folder`` (A4); only metadata is read."""
    return gated(list_files(spark, folder), suffixes)


def read_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str) -> DataFrame:
    """Rows of accepted files of mixed suffixes, with the file's name as ``_file_name``. A line or file
    that does not fit fails the read."""
    rows = None
    for suffix in ACCEPTED_SUFFIXES:
        own = [p for p in paths if p.lower().endswith(suffix)]
        if own:
            reader = spark.read.schema(schema).option("ignoreCorruptFiles", "false")
            part = (reader.option("header", True).option("mode", "FAILFAST").csv(own) if suffix == ".csv"
                    else reader.parquet(*own))
            part = part.withColumn("_file_name", F.col("_metadata.file_name"))
            rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        empty = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        rows = spark.createDataFrame([], empty).withColumn("_file_name", F.lit(None).cast("string"))
    return rows


def read_accepted(spark: SparkSession, folder: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected)`` of a landing folder: the rows of all accepted files, and the rejected files
    with their reasons (the gate in front of the readers). The list of files, not of rows, is on the driver."""
    gate = gate_files(spark, folder)
    paths = [r["path"] for r in gate.filter("accepted").select("path").toLocalIterator()]
    return read_files(spark, paths, schema), gate.filter("not accepted").select("path", "size", "reason")
