"""Operational KPI reports (SLA, resolution percentiles, growth, cohorts,
Pareto, agent ranking, volume anomalies) as DataFrame plans.

Sums and means of measures are exact decimal aggregates (as SQL NUMERIC), so
rounded results do not depend on partitioning or summation order.

Scale notes. Every report first aggregates raw rows with a hash aggregate
(partial aggregation on the map side, so a hot key is combined before the
shuffle). Window functions then run on days or months only, thousands of rows
regardless of input size; ranks and running shares over categories and agents,
whose number grows with the data, go over range partitions. Pass ``by`` to
compute one report per key (region, product line, ...).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsight.operators.ranks import exact_percentiles, match, totals_within, written
from opsight.functions.scalar import (day_of, exact_avg, exact_sum, hours_between, month_offset,
                                      month_start, pct)


def _w(by: Sequence[str]):
    return Window.partitionBy(*by) if by else Window.partitionBy()


def sla_compliance(incidents: DataFrame, by: Sequence[str] = (), rolling_rows: int = 30,
                   lag_rows: int = 7) -> DataFrame:
    """Daily SLA breach %, trailing ``rolling_rows``-row mean, change vs ``lag_rows`` rows back.

    Open tickets (NULL ``resolved_at``) count in ``total_tickets`` but are
    neither met nor breached. LAG counts rows, not days: gaps shift it.
    ``wow_change`` is the rounded daily value minus the unrounded lagged value.
    """
    resolved, deadline = F.col("resolved_at"), F.col("sla_deadline")
    daily = incidents.groupBy(*by, day_of("created_at").alias("report_date")).agg(
        F.count(F.lit(1)).alias("total_tickets"),
        F.sum(F.when(resolved <= deadline, 1).otherwise(0)).cast("long").alias("met_sla"),
        F.sum(F.when(resolved > deadline, 1).otherwise(0)).cast("long").alias("breached_sla"),
    )
    w = _w(by).orderBy("report_date")
    breach = pct("breached_sla", "total_tickets")
    rolled = daily.select(
        *by, "report_date", "total_tickets", "breached_sla",
        F.round(breach, 2).alias("daily_breach_pct"),
        F.avg(breach).over(w.rowsBetween(-(rolling_rows - 1), 0)).alias("rolling_pct"),
        F.lag(breach, lag_rows).over(w).alias("lag_pct"),
    )
    return rolled.select(
        *by, "report_date", "total_tickets", "breached_sla", "daily_breach_pct",
        F.round("rolling_pct", 2).alias("rolling_30d_breach_pct"),
        F.round(F.col("daily_breach_pct") - F.coalesce("lag_pct", "daily_breach_pct"), 2)
        .alias("wow_change"),
    ).orderBy(*by, F.col("report_date").desc())


def resolution_percentiles(incidents: DataFrame, by: Sequence[str] = ("priority",),
                           exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Resolution-time count, mean, P50/P90/P95, min, max per group (hours, 2 digits).

    ``exact`` interpolates linearly between distributed ranks; ``exact=False`` uses
    ``percentile_approx``. Groups are joined on ``by``, one row each.
    """
    hrs = hours_between("created_at", "resolved_at")
    base = incidents.filter(F.col("resolved_at").isNotNull()).select(*by, hrs.alias("hrs"))
    agg = base.groupBy(*by).agg(
        F.count(F.lit(1)).alias("ticket_count"),
        exact_avg("hrs").alias("avg_hrs"),
        *([] if exact else [F.percentile_approx("hrs", [0.5, 0.9, 0.95], accuracy).alias("q")]),
        F.min("hrs").alias("min_hrs_raw"),
        F.max("hrs").alias("max_hrs_raw"),
    )
    if exact:
        q = exact_percentiles(base, by, [0.5, 0.9, 0.95], "hrs").drop("n")
        q = q.select(*[F.col(c).alias(f"__{c}") for c in by], "q")
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        agg = agg.join(q, same, "left")
    return agg.select(
        *by, "ticket_count",
        F.round("avg_hrs", 2).alias("avg_resolution_hrs"),
        F.round(F.col("q")[0], 2).alias("median_hrs"),
        F.round(F.col("q")[1], 2).alias("p90_hrs"),
        F.round(F.col("q")[2], 2).alias("p95_hrs"),
        F.round("min_hrs_raw", 2).alias("min_hrs"),
        F.round("max_hrs_raw", 2).alias("max_hrs"),
    ).orderBy(F.col("avg_resolution_hrs").desc())


def revenue_growth(transactions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Monthly active customers, revenue, mean ticket; MoM / YoY growth (LAG 1 / 12
    months present) and 3-month trailing mean revenue."""
    monthly = transactions.groupBy(*by, month_start("transaction_date").alias("month")).agg(
        F.count_distinct("customer_id").alias("active_customers"),
        exact_sum("amount").alias("revenue"),
        exact_avg("amount").alias("avg_amount"),
    )
    w = _w(by).orderBy("month")
    prev1 = F.lag("revenue", 1).over(w)
    prev12 = F.lag("revenue", 12).over(w)
    return monthly.select(
        *by, "month", "active_customers",
        F.round("revenue", 2).alias("total_revenue"),
        F.round("avg_amount", 2).alias("avg_transaction"),
        F.round((F.col("revenue") - prev1) / F.nullif(prev1, F.lit(0.0)) * 100, 2).alias("mom_growth_pct"),
        F.round((F.col("revenue") - prev12) / F.nullif(prev12, F.lit(0.0)) * 100, 2).alias("yoy_growth_pct"),
        F.round(F.avg("revenue").over(w.rowsBetween(-2, 0)), 2).alias("rolling_3m_avg"),
    ).orderBy(*by, F.col("month").desc())


def cohort_retention(transactions: DataFrame, customers: DataFrame,
                     max_months: int = 12) -> DataFrame:
    """Distinct active customers per (signup-month cohort, months since signup)
    and retention % against the cohort's lowest offset present (0..max_months).

    The join is on ``customer_id``; the optimizer picks broadcast only when the
    cohort side is measured small, else a sort-merge join whose exchange on
    ``customer_id`` is shared with the per-customer aggregation upstream.
    Negative offsets (activity before the cohort month) are dropped.
    """
    cohorts = customers.select("customer_id", month_start("first_purchase_date").alias("cohort_month"))
    act = transactions.select("customer_id", "transaction_date").join(cohorts, "customer_id", "inner") \
        .select("customer_id", "cohort_month",
                month_offset("transaction_date", "cohort_month").alias("months_since_signup")) \
        .filter(F.col("months_since_signup").between(0, max_months))
    counts = act.groupBy("cohort_month", "months_since_signup").agg(
        F.count_distinct("customer_id").alias("active_customers"))
    w = Window.partitionBy("cohort_month").orderBy("months_since_signup")
    return counts.select(
        "cohort_month", "months_since_signup", "active_customers",
        F.round(F.col("active_customers").cast("double")
                / F.first("active_customers").over(w).cast("double") * 100, 1).alias("retention_pct"),
    ).orderBy("cohort_month", "months_since_signup")


def pareto(incidents: DataFrame, key: str = "category", cutoff: float = 80.0, by: Sequence[str] = ()) -> DataFrame:
    """Share of incidents per ``key`` and cumulative share in descending count order, within ``by``.

    Tied counts share one cumulative value (as SQL's default RANGE frame). ``pareto_group`` tests the
    rounded cumulative %. The running sum goes over range partitions, so any number of keys works.
    """
    counts = incidents.groupBy(*by, key).agg(F.count(F.lit(1)).alias("incident_count")).withColumn("__down", -F.col("incident_count"))
    cum = totals_within(counts, by, ["__down"], "incident_count")
    ranked = match(counts, cum, [*by, "__down"]).select(
        *by, key, "incident_count",
        F.round(F.col("incident_count").cast("double") / F.col("__all") * 100, 2).alias("pct_of_total"),
        F.round(F.col("__upto").cast("double") / F.col("__all") * 100, 2).alias("cumulative_pct"))
    # The two labels.
    return ranked.withColumn("pareto_group", F.when(F.col("cumulative_pct") <= cutoff, "TOP 80%").otherwise("REMAINING")) \
        .orderBy(*by, F.col("incident_count").desc())


def agent_ranking(incidents: DataFrame, min_tickets: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """Per-agent resolved tickets, mean hours, SLA %, mean CSAT; ranks and quartile, within ``by``.

    Only resolved tickets count; agents under ``min_tickets`` are dropped (HAVING). Ranks put NULL CSAT
    last; the quartile breaks ties by ``agent_id``. Ranks are distributed (range partitions), as the
    number of agents grows with the data.
    """
    resolved, deadline = F.col("resolved_at"), F.col("sla_deadline")
    m = incidents.filter(resolved.isNotNull()).groupBy(*by, "agent_id", "agent_name").agg(
        F.count(F.lit(1)).alias("tickets_handled"),
        F.round(exact_avg(hours_between("created_at", "resolved_at")), 2).alias("avg_resolution_hrs"),
        F.round(F.sum(F.when(resolved <= deadline, 1).otherwise(0)).cast("double")
                / F.count(F.lit(1)) * 100, 1).alias("sla_compliance_pct"),
        F.round(exact_avg("satisfaction_score"), 2).alias("avg_csat"),
    ).filter(F.col("tickets_handled") >= min_tickets)
    last = F.lit(float("inf"))  # descending order as ascending negatives, NULL last
    m = written(m.withColumns({"__sla": F.coalesce(-F.col("sla_compliance_pct"), last),
                               "__csat": F.coalesce(-F.col("avg_csat"), last), "__one": F.lit(1)}), "agents")
    out = m
    for order, name in ((["__sla"], "sla_rank"), (["__csat"], "csat_rank"), (["__sla", "agent_id"], "__place")):
        placed = totals_within(m, by, order, "__one").select(
            *by, *order, (F.col("__upto") - F.col("__own") + 1).cast("long").alias(name), F.col("__all").alias(f"{name}_n"))
        out = match(out, placed, [*by, *order])
    n, place = F.col("__place_n"), F.col("__place") - 1
    small, larger = F.floor(n / 4), n % 4  # the first n % 4 quartiles hold one agent more
    quartile = F.when(place < larger * (small + 1), F.floor(place / (small + 1)) + 1).otherwise(
        F.floor((place - larger * (small + 1)) / F.greatest(small, F.lit(1))) + larger + 1)
    return out.select(*by, "agent_name", "tickets_handled", "avg_resolution_hrs", "sla_compliance_pct", "avg_csat",
                      "sla_rank", "csat_rank", quartile.cast("long").alias("performance_quartile")) \
        .orderBy(*by, F.col("sla_compliance_pct").desc_nulls_last())


def volume_anomaly(incidents: DataFrame, by: Sequence[str] = (), window: int = 30,
                   sigma: float = 2.0) -> DataFrame:
    """Days whose ticket count lies outside trailing mean ± sigma·std (frame
    includes the current day, partial frames at the start)."""
    daily = incidents.groupBy(*by, day_of("created_at").alias("report_date")).agg(
        F.count(F.lit(1)).alias("ticket_count"))
    w = _w(by).orderBy("report_date").rowsBetween(-(window - 1), 0)
    stats = daily.select(
        *by, "report_date", "ticket_count",
        F.avg("ticket_count").over(w).alias("rolling_avg"),
        F.stddev_samp("ticket_count").over(w).alias("rolling_std"),
    )
    hi = F.col("rolling_avg") + sigma * F.col("rolling_std")
    lo = F.col("rolling_avg") - sigma * F.col("rolling_std")
    n = F.col("ticket_count")
    return stats.filter((n > hi) | (n < lo)).select(
        *by, "report_date", "ticket_count",
        F.round("rolling_avg", 1).alias("rolling_30d_avg"),
        F.round("rolling_std", 1).alias("rolling_30d_std"),
        F.when(n > hi, "HIGH ANOMALY").when(n < lo, "LOW ANOMALY").otherwise("NORMAL").alias("status"),
    ).orderBy(*by, F.col("report_date").desc())
