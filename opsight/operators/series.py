"""Long series in pieces: row numbers, ranges that carry their neighbours' rows, and chunks.

A series may be longer than a task's memory. Its rows are range-partitioned by time and numbered from the counts of
the partitions before (one row for each partition and series). Windows then run over ranges of row numbers,
each with the rows that its first and last windows need from the ranges beside it; fits run over chunks, which
hold a bounded number of values as an array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsight.operators.ranks import fixed_ranges, match

RANGE_ROWS = 1 << 16
CHUNK_ROWS = 1 << 12


def numbered(df: DataFrame, keys: Sequence[str], ts: str, place: str = "__i", length: str = "__n") -> DataFrame:
    """``df`` with each row's place in its series by ``ts`` (from 1) and the series' length. This runs a job.

    Rows of one series with the same ``ts`` get different places in no fixed order.
    """
    keys = list(keys)
    ranged = fixed_ranges(df, [F.col(k) for k in [*keys, ts]])
    inside = Window.partitionBy("__p", *keys).orderBy(ts)
    local = ranged.withColumn("__r", F.row_number().over(inside))
    series = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    before = series.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("__p", *keys).agg(F.count(F.lit(1)).alias("__c"))
               .select("__p", *keys, F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__o"), F.sum("__c").over(series).alias(length)))
    return match(local, offsets, ["__p", *keys]).select(*df.columns, (F.col("__o") + F.col("__r")).alias(place), length)


def in_ranges(rows: DataFrame, before: int, after: int, size: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with places ``__i`` dealt to ranges ``__range``; rows that windows of the next or the range before
    reach are there too, with ``__own`` false."""
    size = max(size, before, after, 1)
    own, at = F.expr(f"(__i - 1) div {size}"), F.expr(f"(__i - 1) % {size}")
    targets = F.array_compact(F.array(own, F.when((at < after) & (own > 0), own - 1), F.when(at >= size - before, own + 1)))
    return rows.withColumn("__range", F.explode(targets)).withColumn("__own", F.col("__range") == own)


def range_window(keys: Sequence[str]):
    """Windows over the rows of a range in order."""
    return Window.partitionBy(*keys, "__range").orderBy("__i")


def own_rows(rows: DataFrame) -> DataFrame:
    """The result rows of the ranges, without the rows lent by their neighbours."""
    return rows.filter("__own").drop("__own", "__range", "__i", "__n")


def chunks(rows: DataFrame, keys: Sequence[str], value: str, lent: int, size: int = CHUNK_ROWS) -> DataFrame:
    """``keys, n, chunk, first, lent, x``: each chunk's values in order, after ``lent`` values of the chunk before it;
    ``first`` is the place of the first value listed."""
    size = max(size, lent, 1)
    own = F.expr(f"(__i - 1) div {size}")
    dealt = rows.withColumn("chunk", F.explode(F.array_compact(F.array(own, F.when(
        (F.expr(f"(__i - 1) % {size}") >= size - lent) & (F.col("__n") > (own + 1) * size), own + 1)))))
    listed = dealt.groupBy(*keys, F.col("__n").alias("n"), "chunk").agg(
        F.sort_array(F.collect_list(F.struct("__i", F.col(value).cast("double").alias("x")))).alias("v"))  # size + lent values
    return listed.select(*keys, "n", "chunk", F.col("v")[0]["__i"].alias("first"),
                         F.expr(f"cast(chunk * {size} + 1 - v[0].__i as int)").alias("lent"), F.col("v.x").alias("x"))


def sum_arrays(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """``keys, col``: the sums of arrays of one length for each key, place by place."""
    rows = df.select(*keys, F.posexplode(col).alias("__at", "__x"))
    sums = rows.groupBy(*keys, "__at").agg(F.sum("__x").alias("__s"))
    return sums.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("__at", "__s"))).alias("__a")).select(*keys, F.col("__a.__s").alias(col))
