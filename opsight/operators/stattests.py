"""Hypothesis tests as one-row DataFrames.

Every test is (1) one distributed aggregate to per-group sufficient
statistics (count, mean, sample variance, moments, medians), (2) arithmetic
on the few resulting rows in Spark expressions, and (3) a pandas UDF for the
final tail probability. Nothing is collected to the driver; callers may
``first()`` the result or join it onward.

Deviations from the pandas/SciPy original (on purpose):
* normality is Jarque-Bera over all rows instead of Shapiro-Wilk on an
  unseeded sample of at most 5,000 (field ``normality_method``);
* paired samples are paired by row (key) rather than by position after
  separate NULL drops;
* the proportion test uses the non-NULL count per arm as n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsight.functions.distributions import (chi2_upper_p, f_upper_p, normal_two_sided_p,
                                             t_two_sided_p)
from opsight.functions.scalar import effect_size_label, winner_label
from opsight.operators.ranks import exact_percentiles


def _pick(col: str, g: str, label) -> Column:
    return F.max(F.when(F.col("g") == F.lit(label), F.col(col))).alias(f"{col}_{g}")


def _two_groups(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    return df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("x")) \
        .filter(F.col("g").isin(a, b) & F.col("x").isNotNull() & ~F.isnan("x"))


def group_moments(base: DataFrame) -> DataFrame:
    """Per group ``g``: n, mean, sample variance, population skewness and excess
    kurtosis of ``x`` (one aggregate, partial per map task)."""
    return base.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("x").alias("mean"),
        F.var_samp("x").alias("var"),
        F.skewness("x").alias("g1"),
        F.kurtosis("x").alias("g2"),
    )


def group_medians(base: DataFrame) -> DataFrame:
    """``(g, median)`` from distributed ranks."""
    return exact_percentiles(base, ["g"], [0.5], "x").select("g", F.col("q")[0].alias("median"))


def levene_parts(base: DataFrame, medians: DataFrame) -> DataFrame:
    """Per group: n, mean and sample variance of |x − group median| (Brown-Forsythe).

    ``medians`` has one row per group; the optimizer broadcasts it when its
    measured size allows (it is bounded by the number of groups).
    """
    z = base.join(medians.select("g", "median"), "g").select("g", F.abs(F.col("x") - F.col("median")).alias("z"))
    return z.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.avg("z").alias("zbar"),
                              F.var_samp("z").alias("zvar"))


def _levene_w(parts: DataFrame) -> DataFrame:
    """W statistic and degrees of freedom from per-group |x − median| moments."""
    tot = parts.agg(
        F.sum("n").alias("big_n"), F.count(F.lit(1)).alias("k"),
        (F.sum(F.col("n") * F.col("zbar")) / F.sum("n")).alias("zall"),
        F.sum((F.col("n") - 1) * F.coalesce(F.col("zvar"), F.lit(0.0))).alias("ssw"),
    )
    ssb = parts.crossJoin(F.broadcast(tot)).agg(
        F.first("big_n").alias("big_n"), F.first("k").alias("k"), F.first("ssw").alias("ssw"),
        F.sum(F.col("n") * (F.col("zbar") - F.col("zall")) ** 2).alias("ssb"))
    return ssb.select(
        ((F.col("big_n") - F.col("k")) / (F.col("k") - 1) * F.col("ssb") / F.nullif(F.col("ssw"), F.lit(0.0)))
        .alias("levene_w"),
        (F.col("k") - 1).cast("double").alias("levene_d1"),
        (F.col("big_n") - F.col("k")).cast("double").alias("levene_d2"))


def ttest_statistics(df: DataFrame, value: str, group: str, a, b,
                     equal_var: bool | None = None, alpha: float = 0.05, levene: bool = True) -> DataFrame:
    """Statistic part of the independent two-sample t-test.

    Pooled variance is used when ``equal_var`` is True, Welch when False, and
    when None the choice follows Levene's test (pooled iff p > alpha).
    Columns: n, mean, std per group, t_statistic, df (both variants resolved),
    cohens_d, Levene W and p, Jarque-Bera per group. ``levene=False`` leaves out Levene's
    test (NULL columns) and its passes for the medians; the choice then needs ``equal_var``.
    """
    if equal_var is None and not levene:
        raise ValueError("the choice of the variance needs Levene's test or equal_var")
    base = _two_groups(df, value, group, a, b)
    mom = group_moments(base)
    one = mom.agg(*[_pick(c, s, lab) for s, lab in (("a", a), ("b", b))
                    for c in ("n", "mean", "var", "g1", "g2")])
    if levene:
        row = one.crossJoin(F.broadcast(_levene_w(levene_parts(base, group_medians(base)))))  # one row
        row = row.withColumn("levene_p", f_upper_p("levene_w", "levene_d1", "levene_d2"))
    else:
        none = F.lit(None).cast("double")
        row = one.withColumns({"levene_w": none, "levene_p": none})
    n1, n2 = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    v1, v2 = F.col("var_a"), F.col("var_b")
    diff = F.col("mean_a") - F.col("mean_b")
    # try_divide: a zero variance or a one-row group gives NULL, not an error.
    sp2 = F.try_divide((n1 - 1) * v1 + (n2 - 1) * v2, n1 + n2 - 2)
    t_pooled = F.try_divide(diff, F.sqrt(sp2 * (F.lit(1.0) / n1 + F.lit(1.0) / n2)))
    se1, se2 = v1 / n1, v2 / n2
    t_welch = F.try_divide(diff, F.sqrt(se1 + se2))
    df_welch = F.try_divide((se1 + se2) ** 2,
                            F.try_divide(se1 ** 2, n1 - 1) + F.try_divide(se2 ** 2, n2 - 1))
    sd_pool = F.sqrt((v1 + v2) / 2)
    if equal_var is None:
        use_pooled = F.coalesce(F.col("levene_p") > F.lit(alpha), F.lit(False))
    else:
        use_pooled = F.lit(bool(equal_var))
    jb = [(F.col(f"n_{s}").cast("double") / 6 * (F.col(f"g1_{s}") ** 2 + F.col(f"g2_{s}") ** 2 / 4))
          for s in ("a", "b")]
    return row.select(
        F.col("n_a").cast("long").alias("n_a"), F.col("n_b").cast("long").alias("n_b"),
        F.col("mean_a").alias("group_a_mean"), F.col("mean_b").alias("group_b_mean"),
        F.sqrt(v1).alias("std_a"), F.sqrt(v2).alias("std_b"),
        use_pooled.alias("equal_variance"),
        F.when(use_pooled, t_pooled).otherwise(t_welch).alias("t_statistic"),
        F.when(use_pooled, n1 + n2 - 2).otherwise(df_welch).alias("df"),
        t_pooled.alias("t_pooled"), t_welch.alias("t_welch"), df_welch.alias("df_welch"),
        F.when(sd_pool > 0, diff / sd_pool).otherwise(F.lit(0.0)).alias("cohens_d"),
        F.col("levene_w"), F.col("levene_p"),
        jb[0].alias("jb_a"), jb[1].alias("jb_b"),
    )


def ttest(df: DataFrame, value: str, group: str, a, b, alpha: float = 0.05,
          equal_var: bool | None = None) -> DataFrame:
    """Full independent t-test result: statistics, p-value, significance,
    effect size label, normality (Jarque-Bera) and equal-variance flags (I1)."""
    s = ttest_statistics(df, value, group, a, b, equal_var, alpha)
    s = s.withColumn("p_value", t_two_sided_p("t_statistic", "df"))
    return s.select(
        F.lit("Independent t-test").alias("test"),
        "n_a", "n_b", "group_a_mean", "group_b_mean", "t_statistic", "df", "p_value",
        F.lit(alpha).alias("alpha"),
        (F.col("p_value") < alpha).alias("significant"),
        "cohens_d", effect_size_label("cohens_d").alias("effect_size"),
        ((F.exp(-F.col("jb_a") / 2) > alpha) & (F.exp(-F.col("jb_b") / 2) > alpha)).alias("normality_ok"),
        F.lit("jarque-bera").alias("normality_method"),
        "equal_variance", "levene_w", "levene_p",
    )


def paired_statistics(df: DataFrame, a: str, b: str) -> DataFrame:
    """Paired t statistic on rows where both samples are present."""
    agg = df.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")) \
        .filter(F.col("a").isNotNull() & F.col("b").isNotNull()) \
        .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("a") - F.col("b")).alias("mean_diff"),
             F.stddev_samp(F.col("a") - F.col("b")).alias("sd_diff"),
             F.avg("a").alias("group_a_mean"), F.avg("b").alias("group_b_mean"),
             F.var_samp("a").alias("va"), F.var_samp("b").alias("vb"),
             *[(F.count(F.lit(1)) / F.lit(6.0) * (F.skewness(c) ** 2 + F.kurtosis(c) ** 2 / 4)).alias(f"jb_{c}") for c in "ab"])
    sd_pool = F.sqrt((F.col("va") + F.col("vb")) / 2)
    return agg.select(
        F.col("n").cast("long").alias("n_pairs"), "group_a_mean", "group_b_mean", "mean_diff",
        F.try_divide(F.col("mean_diff"), F.col("sd_diff") / F.sqrt(F.col("n").cast("double")))
        .alias("t_statistic"),
        (F.col("n") - 1).cast("double").alias("df"),
        F.when(sd_pool > 0, (F.col("group_a_mean") - F.col("group_b_mean")) / sd_pool)
        .otherwise(F.lit(0.0)).alias("cohens_d"), "jb_a", "jb_b",
    )


def paired_ttest(df: DataFrame, a: str, b: str, alpha: float = 0.05) -> DataFrame:
    """Full paired result: statistics, p-value, significance, effect size, Jarque-Bera normality of both
    samples and Levene's equal-variance flag (I2)."""
    s = paired_statistics(df, a, b).withColumn("p_value", t_two_sided_p("t_statistic", "df"))
    both = df.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).dropna()
    long = both.select(F.explode(F.array(*[F.struct(F.lit(c).alias("g"), F.col(c).alias("x")) for c in "ab"])).alias("v")).select("v.*")
    w = _levene_w(levene_parts(long, group_medians(long)))
    w = w.select("levene_w", f_upper_p("levene_w", "levene_d1", "levene_d2").alias("levene_p"))
    s = s.crossJoin(F.broadcast(w))  # one row
    return s.select(F.lit("Paired t-test").alias("test"), *[c for c in s.columns if not c.startswith("jb_")],
                    F.lit(alpha).alias("alpha"), (F.col("p_value") < alpha).alias("significant"),
                    effect_size_label("cohens_d").alias("effect_size"),
                    ((F.exp(-F.col("jb_a") / 2) > alpha) & (F.exp(-F.col("jb_b") / 2) > alpha)).alias("normality_ok"),
                    F.lit("jarque-bera").alias("normality_method"),
                    (F.col("levene_p") > alpha).alias("equal_variance"))


def anova_statistics(df: DataFrame, value: str, group: str) -> DataFrame:
    """One-way ANOVA F from per-group n, mean, variance (I8); NULL groups/values dropped."""
    base = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("x")) \
        .filter(F.col("g").isNotNull() & F.col("x").isNotNull())
    g = base.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.var_samp("x").alias("v"))
    tot = g.agg(F.sum("n").alias("big_n"), F.count(F.lit(1)).alias("k"),
                (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"))
    parts = g.crossJoin(F.broadcast(tot)).agg(
        F.first("big_n").alias("big_n"), F.first("k").alias("k"),
        F.sum(F.col("n") * (F.col("m") - F.col("grand")) ** 2).alias("ssb"),
        F.sum((F.col("n") - 1) * F.coalesce(F.col("v"), F.lit(0.0))).alias("ssw"))
    return parts.select(
        F.try_divide(F.try_divide(F.col("ssb"), F.col("k") - 1),
                     F.try_divide(F.col("ssw"), F.col("big_n") - F.col("k"))).alias("f_statistic"),
        (F.col("k") - 1).cast("double").alias("df_between"),
        (F.col("big_n") - F.col("k")).cast("double").alias("df_within"),
        F.col("k").cast("long").alias("n_groups"),
        F.col("ssb"), F.col("ssw"))


def anova(df: DataFrame, value: str, group: str, alpha: float = 0.05) -> DataFrame:
    """Full ANOVA result; ``group_means`` maps each group's text to its mean (one entry for each group)."""
    s = anova_statistics(df, value, group).withColumn(
        "p_value", f_upper_p("f_statistic", "df_between", "df_within"))
    means = group_means(df, value, group).agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct(F.col(group).cast("string").alias("k"), F.col("mean").alias("v"))))).alias("group_means"))
    s = s.crossJoin(F.broadcast(means))  # one row
    return s.select(F.lit("One-Way ANOVA").alias("test"), "f_statistic", "p_value", F.lit(alpha).alias("alpha"),
                    (F.col("p_value") < alpha).alias("significant"), "n_groups", "df_between", "df_within", "group_means")


def group_means(df: DataFrame, value: str, group: str) -> DataFrame:
    """Mean of ``value`` per group (E10), long form."""
    return df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.avg(value).alias("mean"))


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts ``(a, b, n)`` of the value pairs without NULLs, long form."""
    return (df.select(F.col(a).alias("a"), F.col(b).alias("b")).filter(F.col("a").isNotNull() & F.col("b").isNotNull())
            .groupBy("a", "b").agg(F.count(F.lit(1)).cast("long").alias("n")))


def chi_square_statistics(df: DataFrame, a: str, b: str, correction: bool = True) -> DataFrame:
    """Chi-square test of independence on the contingency of ``a`` × ``b``.

    One frame of cells carries its row and column totals, and Σ o²/e − n over the non-empty cells is the
    statistic, so empty cells need no enumeration. With one degree of freedom (a 2×2 table) and
    ``correction`` the Yates continuity correction applies, as SciPy's default does: all four cells then
    deviate equally, and Σ 1/e over them is n (Σ 1/row total)(Σ 1/column total). Cramér's V uses the
    corrected statistic.
    """
    cells = contingency(df, a, b).withColumnsRenamed({"a": "ra", "b": "cb", "n": "o"})
    in_row, in_col = Window.partitionBy("ra"), Window.partitionBy("cb")
    full = cells.withColumns({
        "row_total": F.sum("o").over(in_row).cast("double"), "row_cells": F.count(F.lit(1)).over(in_row)}).withColumns({
            "col_total": F.sum("o").over(in_col).cast("double"), "col_cells": F.count(F.lit(1)).over(in_col)})
    by_total = F.col("row_total") * F.col("col_total")
    sums = full.agg(
        F.sum("o").alias("n"), F.sum(F.col("o").cast("double") ** 2 / by_total).alias("ratio"),
        F.round(F.sum(F.lit(1.0) / F.col("row_cells"))).cast("long").alias("n_rows"),
        F.round(F.sum(F.lit(1.0) / F.col("col_cells"))).cast("long").alias("n_cols"),
        F.sum(F.lit(1.0) / F.col("row_cells") / F.col("row_total")).alias("row_inverse"),
        F.sum(F.lit(1.0) / F.col("col_cells") / F.col("col_total")).alias("col_inverse"),
        F.max(F.struct("o", by_total.alias("by_total"))).alias("cell"))
    n = F.col("n").cast("double")
    dev = F.abs(F.col("cell.o") - F.col("cell.by_total") / n)
    yates = (dev - F.least(F.lit(0.5), dev)) ** 2 * n * F.col("row_inverse") * F.col("col_inverse")
    dof = (F.col("n_rows") - 1) * (F.col("n_cols") - 1)
    out = sums.withColumn("dof", dof).withColumn("chi2", F.when(dof == 0, F.lit(0.0)).when(
        (dof == 1) & F.lit(correction), yates).otherwise(n * F.col("ratio") - n))
    min_dim = F.least(F.col("n_rows"), F.col("n_cols")) - 1
    return out.select(
        F.col("chi2").alias("chi2_statistic"), F.col("dof").cast("long").alias("degrees_of_freedom"),
        F.col("n").cast("long").alias("n"),
        F.when(min_dim > 0, F.sqrt(F.col("chi2") / (n * min_dim))).otherwise(F.lit(0.0)).alias("cramers_v"))


def chi_square(df: DataFrame, a: str, b: str, alpha: float = 0.05, correction: bool = True) -> DataFrame:
    s = chi_square_statistics(df, a, b, correction)
    p = F.when(F.col("degrees_of_freedom") == 0, F.lit(1.0)).otherwise(
        chi2_upper_p("chi2_statistic", F.col("degrees_of_freedom").cast("double")))
    return s.select(F.lit("Chi-Square Test of Independence").alias("test"), "chi2_statistic",
                    p.alias("p_value"), "degrees_of_freedom", "cramers_v",
                    F.lit(f"{a} x {b}").alias("variables")) \
        .withColumn("significant", F.col("p_value") < alpha)


def ab_proportion_statistics(df: DataFrame, success: str, arm: str, control, treatment) -> DataFrame:
    """Two-proportion z statistic and lift (I7). n per arm counts non-NULL outcomes."""
    g = df.select(F.col(arm).alias("g"), F.col(success).cast("double").alias("x")) \
        .filter(F.col("g").isin(control, treatment)) \
        .groupBy("g").agg(F.count(F.lit(1)).alias("n_total"), F.count("x").alias("n"),
                          F.sum("x").alias("s"))
    one = g.agg(*[_pick(c, s, lab) for s, lab in (("c", control), ("t", treatment)) for c in ("n", "s", "n_total")])
    nc, nt = F.col("n_c").cast("double"), F.col("n_t").cast("double")
    pc, pt = F.col("s_c") / nc, F.col("s_t") / nt
    pool = (F.col("s_c") + F.col("s_t")) / (nc + nt)
    se = F.sqrt(pool * (1 - pool) * (F.lit(1.0) / nc + F.lit(1.0) / nt))
    return one.select(
        F.col("n_total_c").cast("long").alias("n_control"), F.col("n_total_t").cast("long").alias("n_treatment"),
        pc.alias("control_rate"), pt.alias("treatment_rate"),
        F.when(pc > 0, (pt - pc) / pc * 100).otherwise(F.lit(0.0)).alias("lift_pct"),
        F.when(se > 0, (pt - pc) / se).otherwise(F.lit(0.0)).alias("z_statistic"))


def ab_test_proportion(df: DataFrame, success: str, arm: str, control, treatment,
                       alpha: float = 0.05) -> DataFrame:
    s = ab_proportion_statistics(df, success, arm, control, treatment) \
        .withColumn("p_value", normal_two_sided_p("z_statistic"))
    s = s.withColumn("significant", F.col("p_value") < alpha)
    return s.select(F.lit("Two-Proportion Z-Test").alias("test"), "*",
                    winner_label("significant", "lift_pct").alias("winner"))


def ab_continuous_statistics(df: DataFrame, value: str, arm: str, control, treatment) -> DataFrame:
    """Welch t (control − treatment) and lift of means (treatment vs control)."""
    t = ttest_statistics(df, value, arm, control, treatment, equal_var=False, levene=False)
    return t.select(
        F.col("group_a_mean").alias("control_mean"), F.col("group_b_mean").alias("treatment_mean"),
        F.when(F.col("group_a_mean") != 0,
               (F.col("group_b_mean") - F.col("group_a_mean")) / F.col("group_a_mean") * 100)
        .otherwise(F.lit(0.0)).alias("lift_pct"),
        "t_statistic", "df")


def ab_test_continuous(df: DataFrame, value: str, arm: str, control, treatment,
                       alpha: float = 0.05) -> DataFrame:
    s = ab_continuous_statistics(df, value, arm, control, treatment) \
        .withColumn("p_value", t_two_sided_p("t_statistic", "df"))
    s = s.withColumn("significant", F.col("p_value") < alpha)
    return s.select(F.lit("Welch's t-test (A/B)").alias("test"), "*",
                    winner_label("significant", "lift_pct").alias("winner"))
