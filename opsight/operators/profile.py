"""Column profiling, histograms, outlier summaries, segment rates and
correlation matrices (E8-E15, I10, I11).

Each profile is one wide aggregate over the data (k columns × m statistics
in a single pass, partial per map task) whose one-row result is unpivoted to
long form with ``explode`` — the loop over columns of the original becomes
expressions, not jobs. Per-column statistics that a second pass needs
(histogram edges, outlier bounds) are joined back as a one-row frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsight.functions.scalar import exact_avg
from opsight.operators.cleaning import nan_to_null
from opsight.operators.ranks import average_rank, running_totals, summary_percentiles, unpivoted, value_summary


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def corrected_skewness(g1: Column, n: Column) -> Column:
    """Bias-corrected sample skewness G1 from population g1 (pandas ``skew``)."""
    n = n.cast("double")
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurtosis(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis G2 from population excess g2 (pandas ``kurtosis``)."""
    n = n.cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """``(column, unique_count)`` for each column, NULLs not counted.

    Exact counts group each column on its typed value (0.0 and -0.0 are one value, as in SQL): for each
    type one unpivoted pass of ``(column, value)``, partially de-duplicated before its shuffle.
    """
    cols = list(columns)
    if not exact:
        row = df.agg(*[F.approx_count_distinct(c).alias(f"u{i}") for i, c in enumerate(cols)])
        return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                       F.col(f"u{i}").cast("long").alias("unique_count"))
                                              for i, c in enumerate(cols)])).alias("u")).select("u.*")
    by_type: dict[str, list[str]] = {}
    for c in cols:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    counted = None
    for names in by_type.values():
        pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in names])).alias("p"))
        part = (pairs.select("p.*").filter(F.col("v").isNotNull()).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("column").agg(F.count(F.lit(1)).cast("long").alias("unique_count")))
        counted = part if counted is None else counted.unionByName(part)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(counted, "column", "left").select(
        "column", F.coalesce("unique_count", F.lit(0).cast("long")).alias("unique_count"))


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = True,
            exact_median: bool = True) -> DataFrame:
    """One row per column: dtype, non-NULL, NULL, NULL %, distinct values,
    duplicate rows of the whole frame, and for numeric columns mean, median,
    sample std, corrected skewness and kurtosis (E12). NaN counts as NULL, as in
    pandas. The mean is taken from an exact decimal sum where it fits.

    Moments come from one aggregate, medians and distinct counts of numeric columns from one summary of
    counted values (:func:`~opsight.operators.ranks.value_summary`), distinct counts of the others and duplicate
    rows from grouped passes. ``exact_distinct=False`` switches to
    HyperLogLog and ``exact_median=False`` to ``percentile_approx``.
    """
    df = nan_to_null(df)
    cols = list(columns or df.columns)
    nums = set(_numeric(df))
    dtypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    exprs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        col = F.col(c)
        exprs.append(F.count(col).alias(f"nn{i}"))
        if c in nums:
            x = col.cast("double")
            exprs += [exact_avg(col).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                      F.skewness(x).alias(f"g1{i}"), F.kurtosis(x).alias(f"g2{i}")]
    stats = df.agg(*exprs)
    dups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n")) \
        .agg((F.sum("n") - F.count(F.lit(1))).cast("long").alias("duplicate_rows"))
    wide = stats.crossJoin(F.broadcast(dups))
    none = F.lit(None).cast("double")
    entries = []
    for i, c in enumerate(cols):
        nn = F.col(f"nn{i}")
        num = c in nums
        entries.append(F.struct(
            F.lit(c).alias("column"), F.lit(dtypes[c]).alias("dtype"),
            nn.cast("long").alias("non_null_count"),
            (F.col("__rows") - nn).cast("long").alias("null_count"),
            F.round((F.col("__rows") - nn) / F.nullif(F.col("__rows").cast("double"), F.lit(0.0)) * 100, 2)
            .alias("null_pct"),
            F.col("duplicate_rows"),
            (F.col(f"m{i}") if num else none).alias("mean"),
            (F.col(f"s{i}") if num else none).alias("std"),
            (corrected_skewness(F.col(f"g1{i}"), nn) if num else none).alias("skewness"),
            (corrected_kurtosis(F.col(f"g2{i}"), nn) if num else none).alias("kurtosis"),
        ))
    long = wide.select(F.explode(F.array(*entries)).alias("p")).select("p.*")
    numeric = [c for c in cols if c in nums]
    summary = value_summary(df, numeric) if numeric and (exact_median or exact_distinct) else None
    long = long.join(_medians(df, numeric, exact_median, summary), "column", "left")
    if exact_distinct and summary is not None:
        names = df.sparkSession.createDataFrame([(c,) for c in numeric], "column string")
        own = names.join(summary.groupBy("column").agg(F.sum("forms").alias("unique_count")), "column", "left")
        uniq = own.select("column", F.coalesce("unique_count", F.lit(0).cast("long")).alias("unique_count"))
        rest = [c for c in cols if c not in nums]
        uniq = uniq.unionByName(distinct_counts(df, rest)) if rest else uniq
    else:
        uniq = distinct_counts(df, cols, exact_distinct)
    return long.join(uniq, "column").select(
        "column", "dtype", "non_null_count", "null_count", "null_pct", "unique_count", "duplicate_rows",
        "mean", "median", "std", "skewness", "kurtosis")


def _medians(df: DataFrame, cols: Sequence[str], exact: bool, summary: DataFrame | None) -> DataFrame:
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, median double")
    if exact:
        return summary_percentiles(summary, [0.5]).select("column", F.col("q")[0].alias("median"))
    long = unpivoted(df, cols)
    return long.groupBy("column").agg(F.percentile_approx("value", 0.5, 10000).alias("median"))


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 30,
              by: str | None = None) -> DataFrame:
    """Equal-width histogram of every numeric column, or of the given ones.

    Bin i (1..bins) covers [lo + (i−1)·w, lo + i·w); the maximum falls in the
    last bin. With ``by`` the counts are split by that column (e.g. churned
    vs retained) on common edges. Columns are unpivoted and counted in one
    aggregate: only (column, bin[, by]) partial counts are shuffled.
    """
    cols = list(columns or _numeric(df))
    rng = df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
                 *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)])
    longs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"),
                 F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"))
        for i, c in enumerate(cols)]))
    keep = [by] if by else []
    long = df.select(*keep, *cols).crossJoin(F.broadcast(rng)).select(*keep, longs.alias("v")) \
        .select(*keep, "v.*").filter(F.col("x").isNotNull())
    width = F.col("hi") - F.col("lo")
    raw = F.floor((F.col("x") - F.col("lo")) / F.nullif(width, F.lit(0.0)) * bins) + 1
    b = F.least(F.coalesce(raw, F.lit(1)), F.lit(bins)).cast("int")
    counts = long.groupBy("column", *keep, b.alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
    step = (F.col("hi") - F.col("lo")) / bins
    return counts.select(
        "column", *keep, "bin",
        (F.col("lo") + (F.col("bin") - 1) * step).alias("bin_lower"),
        (F.col("lo") + F.col("bin") * step).alias("bin_upper"),
        F.col("count").cast("long").alias("count"))


def outlier_summary(df: DataFrame, columns: Sequence[str] | None = None, method: str = "iqr",
                    summary: DataFrame | None = None) -> DataFrame:
    """Per column: outlier count and % of non-NULL rows, lower and upper bound.

    ``iqr``: outside Q1 − 1.5·IQR, Q3 + 1.5·IQR. ``zscore``: |x − mean| / σ > 3
    with the population σ (as ``scipy.stats.zscore``), while the reported
    bounds use the sample σ (as the original does). Percentiles and counts are read from a
    :func:`~opsight.operators.ranks.value_summary` (the given one, or a new one); means and deviations come
    from one aggregate over the rows. Columns without values have no bounds and no outliers.
    """
    if method not in ("iqr", "zscore"):
        raise ValueError("method must be 'iqr' or 'zscore'")
    cols = list(columns or _numeric(df))
    df = nan_to_null(df)
    summary = value_summary(df, cols) if summary is None else summary
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "__at int, column string")
    if method == "iqr":
        q = summary_percentiles(summary, [0.25, 0.75])  # a row for each column
        spread = 1.5 * (F.col("q")[1] - F.col("q")[0])
        bounds = q.select("column", (F.col("q")[0] - spread).alias("lo"), (F.col("q")[1] + spread).alias("hi"))
        out = (F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))
    else:
        x = [F.col(c).cast("double") for c in cols]
        st = df.agg(*[e for i, c in enumerate(x) for e in (F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"), F.stddev_pop(c).alias(f"p{i}"))])
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("m"), F.col(f"s{i}").alias("s"), F.col(f"p{i}").alias("p"))
                                   for i, c in enumerate(cols)]))
        bounds = st.select(each.alias("b")).select("b.*").withColumns({"lo": F.col("m") - 3 * F.col("s"), "hi": F.col("m") + 3 * F.col("s")})
        out = F.try_divide(F.abs(F.col("value") - F.col("m")), F.col("p")) > 3
    counts = (summary.join(F.broadcast(bounds), "column")  # a row for each column
              .groupBy("column").agg(F.sum(F.when(F.coalesce(out, F.lit(False)), F.col("n")).otherwise(F.lit(0))).alias("o"), F.max("total").alias("t")))
    rows = names.join(bounds, "column", "left").join(counts, "column", "left")
    return rows.select(
        "column", F.lit(method.upper()).alias("method"), F.coalesce("o", F.lit(0)).cast("long").alias("n_outliers"),
        F.round(F.col("o") / F.col("t").cast("double") * 100, 2).alias("pct_outliers"),
        F.round("lo", 4).alias("lower_bound"), F.round("hi", 4).alias("upper_bound"))


def segment_rates(df: DataFrame, segments: Sequence[str], target: str = "churn") -> DataFrame:
    """Mean of ``target`` per value of each segment column, in one aggregate.

    The segment columns are unpivoted (``explode``) and grouped once by
    (segment, value); sort by rate descending within a segment to reproduce
    the ranked view.
    """
    long = df.select(F.col(target).cast("double").alias("t"), F.explode(F.array(*[
        F.struct(F.lit(s).alias("segment"), F.col(s).cast("string").alias("value")) for s in segments])).alias("s")) \
        .select("s.segment", "s.value", "t")
    return long.groupBy("segment", "value").agg(
        F.avg("t").alias("rate"), F.count(F.lit(1)).alias("n")) \
        .orderBy("segment", F.col("rate").desc())


def headline(df: DataFrame, target: str = "churn") -> DataFrame:
    """Totals, rate, positives and negatives of a 0/1 target."""
    t = F.col(target)
    return df.agg(F.count(F.lit(1)).alias("total"), F.avg(t.cast("double")).alias("rate"),
                  F.sum(t).cast("long").alias("positives"),
                  F.sum(F.lit(1) - t).cast("long").alias("negatives"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None,
                       method: str = "pearson") -> DataFrame:
    """Upper-triangle correlations ``(feature_1, feature_2, correlation)``.

    Pearson: k(k−1)/2 ``corr`` expressions in one aggregate; each pair uses
    the rows where both values are present. Spearman: Pearson of average
    ranks; the columns of rows without missing values are ranked once each,
    pairs that miss other rows are ranked on their own rows. Kendall: tau-b
    (see :func:`kendall_tau`).
    """
    df = nan_to_null(df)
    cols = list(columns or _numeric(df))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if method == "pearson":
        row = df.agg(*[F.corr(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")).alias(f"r{i}_{j}")
                       for i, j in pairs])
    elif method in ("spearman", "kendall"):
        return _rank_correlations(df, cols, pairs, method)
    else:
        raise ValueError("method must be 'pearson', 'spearman' or 'kendall'")
    entries = [F.struct(F.lit(cols[i]).alias("feature_1"), F.lit(cols[j]).alias("feature_2"),
                        F.col(f"r{i}_{j}").alias("correlation")) for i, j in pairs]
    return row.select(F.explode(F.array(*entries)).alias("c")).select("c.*")


def _rank_correlations(df: DataFrame, cols: Sequence[str], pairs: list[tuple[int, int]], method: str) -> DataFrame:
    """Spearman or Kendall rows for each pair of columns."""
    typed = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    rows = []
    if method == "kendall":
        rows = [kendall_tau(typed, f"x{i}", f"x{j}").select(
            F.lit(cols[i]).alias("feature_1"), F.lit(cols[j]).alias("feature_2"), F.col("tau").alias("correlation")) for i, j in pairs]
    else:
        missing = typed.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in typed.columns]).first()
        whole = [i for i in range(len(cols)) if not missing[f"x{i}"]]
        if len(whole) > 1:  # columns without missing values: one rank each serves all their pairs
            ranked = typed.select(*[f"x{i}" for i in whole])
            for i in whole:
                ranked = average_rank(ranked, f"x{i}", f"r{i}")
            one = ranked.agg(*[F.corr(f"r{i}", f"r{j}").alias(f"c{i}_{j}") for i, j in pairs if i in whole and j in whole])
            entries = [F.struct(F.lit(cols[i]).alias("feature_1"), F.lit(cols[j]).alias("feature_2"),
                                F.col(f"c{i}_{j}").alias("correlation")) for i, j in pairs if i in whole and j in whole]
            rows.append(one.select(F.explode(F.array(*entries)).alias("c")).select("c.*"))
        for i, j in pairs:
            if i in whole and j in whole and len(whole) > 1:
                continue
            both = typed.select(F.col(f"x{i}").alias("a"), F.col(f"x{j}").alias("b")).dropna()
            ranked = average_rank(average_rank(both, "a", "ra"), "b", "rb")
            rows.append(ranked.agg(F.corr("ra", "rb").alias("correlation")).select(
                F.lit(cols[i]).alias("feature_1"), F.lit(cols[j]).alias("feature_2"), "correlation"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def kendall_tau(df: DataFrame, x: str, y: str) -> DataFrame:
    """Kendall's tau-b of two columns over the rows where both are present, as one row ``tau, n``.

    Discordant pairs are the inversions of the y order among rows in x order. They are counted by
    bits: both columns are replaced by dense ranks; two rows are inverted when, at the highest bit in
    which their y ranks differ, the row with the larger x rank has a 0. So for each bit the rows are
    grouped by the higher bits of y (one unpivoted pass of log2(n) rows for each cell), and a running
    count of ones before each zero gives the inversions; equal x ranks are taken together. No pair of
    rows is ever formed.
    """
    cells = (df.select(F.col(x).alias("x"), F.col(y).alias("y")).dropna()
             .groupBy("x", "y").agg(F.count(F.lit(1)).alias("w")))
    one = running_totals(cells.select("y", F.lit(1).alias("__n")).distinct(), ["y"], ["__n"], prefix="r_")
    ranked = cells.join(one.select("y", F.col("r___n").alias("ry")), "y")
    top = one.agg(F.max("r___n").alias("m"))
    level = (ranked.join(F.broadcast(top)).withColumn("b", F.expr(
        "transform(sequence(0, cast(floor(log2(m)) as int)), k -> struct(k as bit, shiftright(ry, k + 1) as above, "
        "shiftright(ry, k) & 1 as one))")).select("x", "w", F.explode("b").alias("b"))
        .select("x", "b.bit", "b.above", (F.col("w") * F.col("b.one")).alias("ones"), (F.col("w") * (1 - F.col("b.one"))).alias("zeros")))
    order = ["bit", "above", "x"]
    run = running_totals(level, order, ["ones", "zeros"], prefix="up_")
    start = run.groupBy("bit", "above").agg(F.min(F.col("up_ones") - F.col("ones")).alias("base"))
    inverted = (run.join(start, ["bit", "above"])
                .agg(F.sum(F.col("zeros").cast("double") * (F.col("up_ones") - F.col("ones") - F.col("base"))).alias("d")))
    square = lambda c: F.sum(F.col(c).cast("double") * (F.col(c) - 1) / 2)
    total = cells.agg(F.sum("w").alias("n"), square("w").alias("txy"))
    tx = cells.groupBy("x").agg(F.sum("w").alias("w")).agg(square("w").alias("tx"))
    ty = cells.groupBy("y").agg(F.sum("w").alias("w")).agg(square("w").alias("ty"))
    one_row = total.crossJoin(F.broadcast(tx)).crossJoin(F.broadcast(ty)).crossJoin(F.broadcast(inverted))
    pairs = F.col("n").cast("double") * (F.col("n") - 1) / 2
    d = F.coalesce("d", F.lit(0.0))
    concordant = pairs - F.col("tx") - F.col("ty") + F.col("txy") - d
    return one_row.select(F.try_divide(concordant - d, F.sqrt((pairs - F.col("tx")) * (pairs - F.col("ty")))).alias("tau"), "n")


def high_correlations(matrix: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Pairs with |r| ≥ threshold, compared unrounded."""
    return matrix.filter(F.abs(F.col("correlation")) >= threshold)
