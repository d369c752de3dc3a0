"""Exact order statistics without a state that holds all distinct values.

Values are counted by key (partial aggregation, one row for each distinct value, spread over all
tasks), the counts are range-partitioned by key and value, and running totals over the partitions give
every value's ranks. Percentiles then pick the two neighbouring ranks with a plain aggregate. Nothing
meets in one task but one row for each partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsight.session import shared_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, for plans that read it several times. Runs a job."""
    path = shared_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with_running_sums(cols: Sequence[str]):
    """Add the running sums ``__l_<col>`` of the columns ``__s_<col>`` over a task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upto: list[pa.Scalar | None] = [None] * len(cols)
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = []
            for i, c in enumerate(cols):
                own = batch.column(batch.schema.names.index(f"__s_{c}"))
                own = pc.fill_null(own, pa.scalar(0).cast(own.type))
                if pa.types.is_decimal(own.type):  # Arrow adds these up in Python only
                    own = pa.array(list(accumulate(own.to_pylist(), initial=upto[i].as_py() if upto[i] else 0))[1:], own.type)
                else:
                    own = pc.cumulative_sum_checked(own, start=upto[i])
                sums.append(own)
                upto[i] = own[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums], [*batch.schema.names, *[f"__l_{c}" for c in cols]])
    return run


def fixed_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` range-partitioned by ``order``, with the partition as ``__p``, as a written table.

    Range bounds are sampled, so a plan that used them twice could see two partitionings; the table
    (in the shared checkpoint folder) fixes one. This runs a job.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(parts, *order).withColumn("__p", F.spark_partition_id()), "ranges")


def summed_ranges(grouped: DataFrame, order: Sequence[Column], cols: Sequence[str]) -> DataFrame:
    """:func:`fixed_ranges` with the running sums ``__l_<col>`` of the columns ``__s_<col>`` within each range: the
    task that gets a range sorts it, sums it up and writes it, so rows are shuffled once."""
    parts = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = grouped.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, *[T.StructField(f"__l_{c}", ranged.schema[f"__s_{c}"].dataType) for c in cols]])
    return written(ranged.mapInArrow(_with_running_sums(cols), schema), "ranges")


def running_totals(df: DataFrame, order_by: Sequence[str], cols: Sequence[str], descending: bool = False,
                   prefix: str = "cum_") -> DataFrame:
    """Running sums of ``cols`` over the global order of ``order_by``; rows equal in it are one row.

    A partition's own running sums are added to the totals of the partitions before it (one row for
    each partition, so that side is broadcast).
    """
    keys = [F.col(c).desc() if descending else F.col(c).asc() for c in order_by]
    local = summed_ranges(df.groupBy(*order_by).agg(*[F.sum(c).alias(f"__s_{c}") for c in cols]), keys, cols)
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    totals = local.groupBy("__p").agg(*[F.sum(f"__s_{c}").alias(f"__t_{c}") for c in cols])
    offsets = totals.select("__p", *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in cols])
    return local.join(F.broadcast(offsets), "__p").select(
        *order_by, *[F.col(f"__s_{c}").alias(c) for c in cols],
        *[(F.col(f"__o_{c}") + F.col(f"__l_{c}")).alias(f"{prefix}{c}") for c in cols])


def match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left`` with the other columns of ``right`` for equal keys; NULL keys match NULL."""
    renamed = right.select(*[F.col(k).alias(f"__m{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__m{i}"))
    return left.join(renamed, same).drop(*[f"__m{i}" for i in range(len(keys))])


def totals_within(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str) -> DataFrame:
    """``(by..., order..., __own, __upto, __all)``: the sum of ``col`` at each order value, up to it, and of all, within ``by``."""
    ranked = running_totals(df, [*by, *order], [col], prefix="__cum_").withColumnRenamed(col, "__own")
    heads = ranked.groupBy(*by).agg(F.min(F.col(f"__cum_{col}") - F.col("__own")).alias("__start"), F.sum("__own").alias("__all"))
    joined = match(ranked, heads, by) if by else ranked.crossJoin(F.broadcast(heads))  # one row
    return joined.select(*by, *order, "__own", (F.col(f"__cum_{col}") - F.col("__start")).alias("__upto"), "__all")


def unpivoted(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, value)`` with one row for each non-missing numeric value (as double)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.nanvl(
        F.col(c).cast("double"), F.lit(None).cast("double")).alias("value")) for c in columns]))
    return df.select(*by, pairs.alias("__v")).select(*by, "__v.column", "__v.value").filter(F.col("value").isNotNull())


def value_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n, forms, upto, total)``: the values of numeric columns as doubles with their counts, the
    number of different values of the column's own type that this double stands for, the count of all values up to it
    and of all in the column. One shuffle of counted values for all columns, written to the shared folder.

    Distinct counts, percentiles, modes, histograms and outlier counts of all columns can be read from it
    without another pass over the rows. Summaries of parts of the data (days) add up by ``column`` and ``value``.
    """
    plain, inexact = [], []
    for i, c in enumerate(columns):
        kind = df.schema[c].dataType
        value = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        if isinstance(kind, (T.LongType, T.DecimalType)):  # beyond the precision of doubles
            exact = F.when(~value.try_cast(kind).eqNullSafe(F.col(c)), F.col(c).cast("string"))
            inexact.append(F.struct(F.lit(i).alias("at"), value.alias("value"), exact.alias("exact")))
        else:
            plain.append(F.struct(F.lit(i).alias("at"), value.alias("value")))
    one, found = F.count(F.lit(1)).alias("__s_n"), []
    for items, keys in ((plain, ["at", "value"]), (inexact, ["at", "value", "exact"])):
        if items:
            pairs = df.select(F.explode(F.array(*items)).alias("__v")).select("__v.*").filter(F.col("value").isNotNull())
            counts = pairs.groupBy(*keys).agg(one).withColumn("forms", F.lit(1).cast("long"))
            found.append(counts if items is plain else counts.groupBy("at", "value").agg(F.sum("__s_n").alias("__s_n"), F.sum("forms").alias("forms")))
    counts = written(found[0].unionByName(found[1]) if len(found) > 1 else found[0], "counted")  # sampled for its ranges, then read
    ranked = summed_ranges(counts, [F.col("at").asc(), F.col("value").asc()], ["n"])
    parts = ranked.groupBy("at", "__p").agg(F.sum("__s_n").alias("n"), F.min(F.col("__l_n") - F.col("__s_n")).alias("first"))
    # what the column has in ranges before, less what other columns have before it in this range
    before = Window.partitionBy("at").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    heads = parts.select("at", "__p", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("__offset"),
                         F.sum("n").over(Window.partitionBy("at")).alias("total"))
    heads = written(heads.withColumn("column", F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("at") + 1)), "heads")
    return (ranked.join(F.broadcast(heads), ["at", "__p"])  # a row for each column and range
            .select("column", "value", F.col("__s_n").alias("n"), "forms", (F.col("__offset") + F.col("__l_n")).alias("upto"), "total"))


def summary_percentiles(summary: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``(column, q)``: the linearly interpolated percentiles of each column of a :func:`value_summary`."""
    picks, out = [], []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("total") - 1)
        picks += [F.min(F.when(F.col("upto") > F.floor(at), F.col("value"))).alias(f"__lo{i}"),
                  F.min(F.when(F.col("upto") > F.ceil(at), F.col("value"))).alias(f"__hi{i}")]
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi))
    return summary.groupBy("column", "total").agg(*picks).select("column", F.array(*out).alias("q"))


def summary_modes(summary: DataFrame) -> DataFrame:
    """``(column, mode, n)``: the most frequent value of each column of a summary (ties: the smallest)."""
    best = summary.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("m"), "value")).alias("b"))
    return best.select("column", F.col("b.value").alias("mode"), (-F.col("b.m")).alias("n"))


def exact_percentiles(values: DataFrame, keys: Sequence[str], probs: Sequence[float], value: str = "value") -> DataFrame:
    """``(keys..., n, q)``: the linearly interpolated percentiles of ``value`` for each key, as an array.

    NULL keys form a group of their own. The result has one row for each key.
    """
    counts = values.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c"))
    ranked = running_totals(counts, [*keys, value], ["__c"], prefix="__cum")
    start = (F.col("__cum__c") - F.col("__c"))
    heads = ranked.groupBy(*keys).agg(F.min(start).alias("__start"), F.sum("__c").alias("n"))
    if keys:
        renamed = heads.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__start", "n")
        cond = None
        for i, k in enumerate(keys):
            same = F.col(k).eqNullSafe(F.col(f"__k{i}"))
            cond = same if cond is None else cond & same
        placed = ranked.join(renamed, cond)
    else:
        placed = ranked.crossJoin(F.broadcast(heads))  # one row
    upto = F.col("__cum__c") - F.col("__start")
    picks = []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("n") - 1)
        picks += [F.min(F.when(upto > F.floor(at), F.col(value))).alias(f"__lo{i}"),
                  F.min(F.when(upto > F.ceil(at), F.col(value))).alias(f"__hi{i}")]
    picked = placed.groupBy(*keys, "n").agg(*picks)
    out = []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi))
    return picked.select(*keys, "n", F.array(*out).alias("q"))


def column_percentiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Percentiles of numeric columns as Python numbers; columns without values are left out.

    All columns share one pass; the result has one row for each column.
    """
    if not columns:
        return {}
    rows = exact_percentiles(unpivoted(df, columns), ["column"], probs).collect()
    return {r["column"]: list(r["q"]) for r in rows}


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """The most frequent value of each column (ties: the smallest); columns without values are left out.

    Values are counted in one grouped pass as text, then compared in their own type.
    """
    if not columns:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    counts = (df.select(pairs.alias("__v")).select("__v.column", "__v.value").filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    typed = [F.min(F.when(F.col("column") == c, F.struct((-F.col("n")).alias("n"), F.col("value").cast(df.schema[c].dataType).alias("v"))))
             .alias(f"m{i}") for i, c in enumerate(columns)]
    row = counts.agg(*typed).first()
    return {c: row[f"m{i}"]["v"] for i, c in enumerate(columns) if row[f"m{i}"] is not None}


def average_rank(df: DataFrame, col: str, out: str) -> DataFrame:
    """Add the average (tie-averaged, 1-based) rank of ``col`` as ``out``.

    Ranks are joined back on the value: one row for each value on that side, so a hot value is split by
    adaptive execution on the other.
    """
    cum = running_totals(df.select(col, F.lit(1).alias("__c")), [col], ["__c"], prefix="__cum")
    ranks = cum.select(col, (F.col("__cum__c") - F.col("__c") + 1 + (F.col("__c") - 1) / 2.0).cast("double").alias(out))
    return df.join(ranks, col)
