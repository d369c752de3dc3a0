"""Sinks: curated zone, JSON quality report, bulk load, upsert, staging cleanup
(A6-A10)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_zone(df: DataFrame, zone_root: str, run_id: str) -> str:
    """Write ``df`` as the partition ``run_id`` of a Parquet zone.

    Dynamic partition overwrite: a retried run replaces its own partition and leaves the others.
    """
    out = df.withColumn("run_id", F.lit(run_id))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(zone_root))
    return f"{zone_root.rstrip('/')}/run_id={run_id}"


def write_report(spark: SparkSession, report: dict, path: str) -> str:
    """Write a quality report as one JSON document (A7). Call it after the last
    field is set. The report is a small dict built on the driver."""
    text = json.dumps(report, default=str, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def truncate_strings(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Cut string columns to their target width (TRUNCATECOLUMNS of a bulk load)."""
    exprs = []
    for f in df.schema.fields:
        if f.name in widths and isinstance(f.dataType, T.StringType):
            exprs.append(F.substring(F.col(f.name), 1, int(widths[f.name])).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def bulk_load(df: DataFrame, table: str, widths: dict[str, int] | None = None,
              mode: str = "append") -> DataFrame:
    """Load ``df`` into ``table`` (a catalog table name or a Parquet path), strings
    cut to ``widths``; columns are matched by name (A8). Returns the loaded frame."""
    loaded = truncate_strings(df, widths or {})
    spark = df.sparkSession
    if "/" in table:
        loaded.write.mode(mode).parquet(table)
    elif spark.catalog.tableExists(table):
        cols = spark.table(table).columns
        loaded.select(*cols).write.insertInto(table, overwrite=(mode == "overwrite"))
    else:
        loaded.write.mode(mode).saveAsTable(table)
    return loaded


def upsert(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete target rows whose key matches a staging row, then insert every
    staging row (A9, D2, H1).

    The delete is a left anti join on key equality, so a NULL key never
    matches: NULL-key rows of both sides survive, and duplicate staging keys
    are all inserted. The anti join only needs the staging keys; the optimizer
    broadcasts them when their measured size is under the broadcast threshold,
    else both sides are shuffled on the keys.
    """
    cond = [target[k] == staging[k] for k in keys]
    kept = target.join(staging.select(*keys), cond, "left_anti")
    return kept.unionByName(staging.select(*target.columns))


BUCKETS = 64  # of a new table; a commit rewrites those that its keys fall into
_BUCKET = "__bucket"
_COMMITS = 20  # attempts before a commit gives up


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path), hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, table_root: str) -> int | None:
    """The table's newest committed version."""
    path, fs = _fs(spark, f"{table_root}/_versions")
    if not fs.exists(path):
        return None
    numbers = [int(n[2:]) for n in (s.getPath().getName() for s in fs.listStatus(path)) if n.startswith("v=")]
    return max(numbers, default=None)


def _manifest(spark: SparkSession, table_root: str, version: int) -> dict:
    """Schema, keys, number of buckets, and the folder of each bucket that has rows."""
    path, fs = _fs(spark, f"{table_root}/_versions/v={version}")
    return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(fs.open(path), "UTF-8"))


def _claim(spark: SparkSession, table_root: str, version: int, manifest: dict) -> bool:
    """Publish a manifest as ``version``; False if another writer already has that number.

    The manifest is written under a name of its own and renamed, which fails where the target exists.
    """
    own, fs = _fs(spark, f"{table_root}/_versions/_{uuid.uuid4().hex}")
    out = fs.create(own)
    out.write(json.dumps(manifest).encode())
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(own, jvm.org.apache.hadoop.fs.Path(f"{table_root}/_versions/v={version}"), none)
    except Py4JJavaError as error:
        fs.delete(own, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def read_version(spark: SparkSession, table_root: str, version: int | None = None) -> DataFrame:
    """The table at ``version`` (the newest one if None)."""
    version = current_version(spark, table_root) if version is None else version
    if version is None:
        raise ValueError(f"no committed version at {table_root}")
    manifest = _manifest(spark, table_root, version)
    return _bucket_rows(spark, manifest, manifest["buckets"])


def _bucket_rows(spark: SparkSession, manifest: dict, buckets) -> DataFrame:
    schema = T.StructType.fromJson(manifest["schema"])
    folders = [manifest["buckets"][b] for b in buckets if b in manifest["buckets"]]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def commit_upsert(spark: SparkSession, table_root: str, staging: DataFrame, keys: Sequence[str],
                  staging_name: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Upsert into the versioned table at ``table_root`` (A9), then drop the staging view or table (A10).

    Rows lie in buckets by a hash of ``keys``; a commit rewrites the buckets of the staging keys and takes over
    the files of the others. A version is a manifest that names each bucket's folder, and its number can be
    claimed once: a writer that finds its number taken starts again from the newest version, so no commit is lost.
    The first commit writes the staging rows alone. Returns the new version.
    """
    keys = list(keys)
    for _ in range(_COMMITS):
        version = current_version(spark, table_root)
        old = _manifest(spark, table_root, version) if version is not None else None
        if old and old["keys"] != keys:
            raise ValueError(f"the table's keys are {old['keys']}")
        count = old["count"] if old else buckets
        bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(count)).cast("int")
        if old:
            touched = [str(r[0]) for r in staging.select(bucket.alias("b")).distinct().collect()]  # at most the buckets
            merged = upsert(_bucket_rows(spark, old, touched), staging, keys)
        else:
            merged = staging
        folder = f"{table_root}/data/{uuid.uuid4().hex}"
        rows = merged.withColumn(_BUCKET, bucket)
        rows.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(folder)
        path, fs = _fs(spark, folder)
        made = {n.split("=")[1]: f"{folder}/{n}" for n in (s.getPath().getName() for s in fs.listStatus(path)) if n.startswith(_BUCKET)}
        kept = {b: f for b, f in old["buckets"].items() if b not in touched} if old else {}
        schema = json.loads(merged.schema.json()) if not old else old["schema"]
        manifest = {"schema": schema, "keys": keys, "count": count, "buckets": {**kept, **made}}
        number = 0 if version is None else version + 1
        if _claim(spark, table_root, number, manifest):
            if staging_name:
                drop_staging(spark, staging_name)
            return read_version(spark, table_root, number)
        fs.delete(path, True)
    raise RuntimeError(f"no version of {table_root} could be claimed in {_COMMITS} attempts")


def drop_staging(spark: SparkSession, name: str) -> None:
    """Remove a staging view or table if it exists (A10)."""
    if not spark.catalog.dropTempView(name):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
