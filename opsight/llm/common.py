"""Shared helpers of the corpus operators: columns, shared tables, bounded row filters."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsight.session import ensure_checkpoint_dir, shared_path

# Java classes of the word contract: words are runs of anything but these separators.
SEPARATORS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

BATCH_BYTES = 8 << 20
# Size of the row filter below: 2**23 bits in 64-bit words, at most 131,072 rows of 16 bytes.
FILTER_BITS = 1 << 23


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times in ``body`` (a one-element ``transform``).

    Plain reuse of a column expression inside a lambda is evaluated again for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The array of words of a text; NULL and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most 8 MB while a job is planned, so that Python workers stay small."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    number = int(before.rstrip("b")) if before.rstrip("b").lstrip("-").isdigit() else None
    with setting(spark, name, str(BATCH_BYTES) if number is not None and not 0 < number <= BATCH_BYTES else before):
        yield


def shared_table(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: a cut in the lineage that
    survives lost executors. The shuffle files that made it go as soon as it is written."""
    path = shared_path(df.sparkSession, "tables", name)
    with small_batches(df.sparkSession), setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.mode("overwrite").option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Remove the files of the shared tables that ``df`` reads; nothing that reads them may be evaluated later."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/") + "/tables/"
    for folder in {"/".join(f.split("/")[:-1]) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if base.split(":", 1)[-1].lstrip("/") in folder:  # schemes are written with one or three slashes
            path.getFileSystem(conf).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a name made from it that ``df`` has no column of (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _slot(*keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))


def flag_rows(df: DataFrame, keys: list[str], wanted: DataFrame, flag: str) -> DataFrame:
    """Add the boolean column ``flag``: false or NULL means that the row's key is certainly not in
    ``wanted`` (which has columns of the same names), true that it may be.

    The filter is a bitmap of fixed size (at most 2 MB whatever the input, so it is broadcast):
    rows that need no join then skip its shuffle. A full bitmap only stops the saving.
    """
    slot = _slot(*[F.col(k) for k in keys])
    word, bits = free_name(df, "slot_word"), free_name(df, "slot_bits")
    filled = (wanted.select(slot.alias("slot"))
              .select(F.expr("shiftright(slot, 6)").alias(word), F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bit"))
              .groupBy(word).agg(F.bit_or("bit").alias(bits)))
    hit = F.coalesce(F.col(bits).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))), F.lit(0)) != 0
    return (df.withColumn(word, F.shiftright(slot, 6)).join(F.broadcast(filled), word, "left")
            .withColumn(flag, hit).drop(word, bits))


def rows_in(df: DataFrame, keys: list[str], wanted: DataFrame, unique: bool = False) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``wanted``; only candidate rows are shuffled.

    Where the keys of ``wanted``, a written table, are ``unique``, no aggregate stands before the join, and adaptive
    execution can split the rows of a hot key.
    """
    maybe = free_name(df, "maybe")
    flagged = flag_rows(df, keys, wanted, maybe).filter(F.col(maybe)).drop(maybe)
    wanted = wanted.select(*keys)
    return flagged.join(wanted if unique else wanted.distinct(), keys, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])


def rows_not_in(df: DataFrame, keys: list[str], unwanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``unwanted``; only candidate rows are shuffled."""
    maybe = free_name(df, "maybe")
    columns = [F.col(f"`{c}`") for c in df.columns]
    flagged = flag_rows(df, keys, unwanted, maybe)
    sure = flagged.filter(~F.coalesce(F.col(maybe), F.lit(False))).select(*columns)
    checked = flagged.filter(F.col(maybe)).join(unwanted.select(*keys).distinct(), keys, "left_anti").select(*columns)
    return sure.unionByName(checked)
