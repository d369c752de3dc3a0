"""Session construction and shared-folder helpers.

The launcher's settings always win: the builder fills in only what neither ``spark-submit``,
``PYSPARK_SUBMIT_ARGS`` nor ``spark-defaults.conf`` sets, and an active session is returned as it is.
The master, the shuffle partitions and the memory get a default for local runs only.
"""

from __future__ import annotations

import os
import shlex
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every job relies on for identical results and runtime re-planning, unless the launcher sets them.
_COMMON = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Defaults of local runs; never applied on a cluster.
_LOCAL = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "16g",
}


def launcher_settings() -> dict[str, str]:
    """What the launcher has set: the running JVM's properties, else the submit arguments and defaults file."""
    if SparkContext._jvm is not None or "PYSPARK_GATEWAY_PORT" in os.environ:
        SparkContext._ensure_initialized()
        return dict(SparkConf().getAll())
    found: dict[str, str] = {}
    folder = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    defaults = os.path.join(folder, "spark-defaults.conf")
    if os.path.isfile(defaults):
        with open(defaults) as lines:
            pairs = [line.split(None, 1) for line in lines if line.strip() and not line.lstrip().startswith("#")]
        found.update({p[0]: p[1].strip() for p in pairs if len(p) == 2})
    named = {"--master": "spark.master", "--driver-memory": "spark.driver.memory", "--executor-memory": "spark.executor.memory"}
    args = [part for a in shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
            for part in (a.split("=", 1) if a.startswith("--") and "=" in a else [a])]
    for flag, value in zip(args, args[1:]):
        if flag in ("--conf", "-c") and "=" in value:
            found.update([value.split("=", 1)])
        elif flag in named:
            found[named[flag]] = value
    return found


def build_session(master: str | None = None, app_name: str = "opsight",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """The active session, or a new one with the launcher's settings and defaults for what is unset.

    ``master`` and ``extra`` are the caller's explicit wishes for a new session. Without a master from
    the caller or the launcher the session is local, with ``$BENCH_CPUS`` threads or all.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    given = launcher_settings()
    master = master or given.get("spark.master") or os.environ.get("SPARK_MASTER") \
        or f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    settings = {**_COMMON, **(_LOCAL if master.startswith("local[") or master == "local" else {})}
    settings = {k: v for k, v in settings.items() if k not in given} | (extra or {})
    spark = SparkSession.builder.appName(app_name).master(master).config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a folder that driver and executors share, and it must be set. Only
    in a local session without it a fresh scratch folder is made and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="opsight-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), *parts, uuid.uuid4().hex])
