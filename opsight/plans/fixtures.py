"""Derived input views over the test tables (see FIXTURES.md §2).

The reference's inputs (incident tickets, transactions, telecom customers, a
daily capacity series, messy ticket exports, ...) are derived here from the
TPC-H-like tables by key arithmetic only, so that the same rows can be built
by an independent SQL engine. Everything is lazy: a view is a plan, and the
calling query's projection decides which joins are needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsight.sources.tables import Tables

# Columns of the `incidents` view and the dimension each one needs.
_INCIDENT_NEEDS = {
    "created_at": set(),
    "resolved_at": set(),
    "sla_deadline": {"orders"},
    "priority": {"orders"},
    "category": {"part"},
    "agent_id": {"supplier"},
    "agent_name": {"supplier"},
    "satisfaction_score": set(),
}
INCIDENT_COLUMNS = tuple(_INCIDENT_NEEDS)


def _add_hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours.cast("int"), ts)


def incidents(t: Tables, columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """Ticket table derived from lineitem ⋈ orders ⋈ part ⋈ supplier.

    Only the dimensions that supply a requested column are joined. The foreign
    keys of lineitem are total in the test data (every l_orderkey / l_partkey /
    l_suppkey exists, keys are unique), so an inner join that is not needed for
    a column neither adds nor removes rows. Dimension joins are left to the
    optimizer: AQE turns them into broadcast joins only when the runtime size
    of the dimension is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    cols = list(columns or INCIDENT_COLUMNS)
    unknown = set(cols) - set(_INCIDENT_NEEDS)
    if unknown:
        raise ValueError(f"unknown incident columns {sorted(unknown)}")
    needs = set().union(*(_INCIDENT_NEEDS[c] for c in cols))

    li = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    df = li
    if "orders" in needs:
        df = df.join(t.orders.select("o_orderkey", "o_orderpriority"),
                     df.l_orderkey == F.col("o_orderkey"), "inner")
    if "part" in needs:
        df = df.join(t.part.select("p_partkey", "p_brand"),
                     df.l_partkey == F.col("p_partkey"), "inner")
    if "supplier" in needs:
        df = df.join(t.supplier.select("s_suppkey", "s_name"),
                     df.l_suppkey == F.col("s_suppkey"), "inner")

    exprs = {
        "created_at": F.col("l_shipdate"),
        "resolved_at": F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"),
                              F.lit(None)).otherwise(
            _add_hours(F.col("l_shipdate"), F.lit(3) * F.col("l_quantity"))),
        "sla_deadline": _add_hours(
            F.col("l_shipdate"),
            F.lit(24) * F.substring("o_orderpriority", 1, 1).cast("int")),
        "priority": F.col("o_orderpriority"),
        "category": F.col("p_brand"),
        "agent_id": F.col("s_suppkey"),
        "agent_name": F.col("s_name"),
        "satisfaction_score": F.when(F.col("l_tax") == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(5.0) - F.lit(40.0) * F.col("l_discount")),
    }
    return df.select(*[exprs[c].alias(c) for c in cols])


def transactions(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").alias("amount"),
    )


def customers(t: Tables) -> DataFrame:
    """First purchase per customer; every tenth customer is shifted by 90 days
    so that some activity falls before the cohort month (negative offsets)."""
    first = t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.min("o_orderdate").alias("first_purchase_date"))
    return first.select(
        "customer_id",
        F.when(F.col("customer_id") % 10 == 0,
               F.timestamp_add("DAY", F.lit(90), F.col("first_purchase_date")))
        .otherwise(F.col("first_purchase_date")).alias("first_purchase_date"),
    )


def telecom(t: Tables) -> DataFrame:
    """Customer-level churn table (customer ⋈ per-customer order aggregates)."""
    per_cust = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.avg("o_totalprice").alias("avg_price"),
        F.count_if(F.col("o_orderstatus") == "F").alias("num_support_tickets"),
        F.count("*").alias("num_orders"),
    )
    months = ((F.year("last_order") * 12 + F.month("last_order"))
              - (F.year("first_order") * 12 + F.month("first_order")))
    tenure = F.least(F.greatest(months, F.lit(1)), F.lit(72))
    monthly = F.lit(20.0) + F.col("avg_price") / F.lit(5000.0)
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.join(per_cust, c.c_custkey == per_cust.o_custkey, "inner").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("contract"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("partner"),
        (F.col("c_nationkey") % 5 == 0).cast("int").alias("senior_citizen"),
        tenure.cast("int").alias("tenure_months"),
        monthly.alias("monthly_charges"),
        (monthly * tenure).alias("total_charges"),
        F.col("num_support_tickets").cast("long").alias("num_support_tickets"),
        F.col("num_orders").cast("long").alias("num_orders"),
        (F.col("last_order") < F.lit("2001-01-01").cast("timestamp_ntz")).cast("int").alias("churn"),
    )


def daily_series(t: Tables) -> DataFrame:
    """Three daily series (one per return flag): sum of quantity per ship day."""
    return t.lineitem.groupBy(
        F.col("l_returnflag").alias("series"),
        F.to_date("l_shipdate").alias("ts"),
    ).agg(F.sum("l_quantity").alias("value"))


def _messy_base(t: Tables) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    return c.select(
        k.alias("id"),
        F.lit(0).alias("batch"),
        F.col("c_name").alias("name"),
        F.when(k % 5 == 1, F.concat(F.lit("  "), seg))
        .when(k % 5 == 2, F.concat(F.lower(seg), F.lit(" ")))
        .when(k % 5 == 3, F.lit(None).cast("string"))
        .otherwise(seg).alias("segment"),
        F.when(k % 10 == 4, F.lit(None).cast("double"))
        .when(k % 97 == 0, F.col("c_acctbal") * 50)
        .otherwise(F.col("c_acctbal")).alias("amount"),
        F.when(k % 5 == 0, F.col("c_name")).alias("mostly_null"),
        F.when(k % 20 == 0, F.lit("n/a"))
        .otherwise(F.floor("c_acctbal").cast("long").cast("string")).alias("amount_txt"),
        F.when(k % 30 == 0, F.lit("not a date"))
        .otherwise(F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), (k % 2000).cast("int")),
                                 "yyyy-MM-dd")).alias("signup_txt"),
        F.col("c_nationkey").alias("nation"),
    )


def messy(t: Tables) -> DataFrame:
    """Customers with injected whitespace/case variants, NULLs, outliers and
    unparsable text; ids with c_custkey % 50 = 7 appear a second time."""
    base = _messy_base(t)
    again = base.filter(F.col("id") % 50 == 7).select(
        "id", F.lit(1).alias("batch"), "name", "segment",
        (F.col("amount") * 2).alias("amount"),
        F.lit(None).cast("string").alias("mostly_null"),
        F.lit("n/a").alias("amount_txt"), "signup_txt", "nation")
    return base.unionByName(again)


def messy_dup(t: Tables) -> DataFrame:
    """`messy` plus exact copies of the rows with id % 25 = 0."""
    m = messy(t)
    return m.unionByName(m.filter(F.col("id") % 25 == 0))


def ab(t: Tables) -> DataFrame:
    e = t.events
    return e.select(
        (F.col("user_id") % 2).cast("int").alias("arm"),
        (F.col("event_type") == "purchase").cast("int").alias("success"),
        F.col("value"),
    )


def scored(t: Tables) -> DataFrame:
    e = t.events
    label = (F.col("event_type") == "purchase").cast("int")
    score = (F.col("event_id") * 7919 % 1000).cast("double") / 1000.0 + F.lit(0.2) * label
    return e.select(F.col("event_id"), label.alias("label"), score.alias("score")) \
        .withColumn("prediction", (F.col("score") >= 0.6).cast("int"))


def paired(t: Tables) -> DataFrame:
    """First and last order price per customer (customers with ≥ 2 orders)."""
    o = t.orders
    order_key = F.struct("o_orderdate", "o_orderkey")
    return o.groupBy(F.col("o_custkey").alias("pair_id")).agg(
        F.min_by("o_totalprice", order_key).alias("first_price"),
        F.max_by("o_totalprice", order_key).alias("last_price"),
        F.count("*").alias("n_orders"),
    ).filter(F.col("n_orders") >= 2).drop("n_orders")


def corr_frame(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select(
        "l_quantity", "l_extendedprice",
        (F.col("l_quantity") * F.col("l_extendedprice")).alias("gross"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("net"),
    )


def upsert_target(t: Tables) -> DataFrame:
    c = t.customer.filter(F.col("c_custkey") % 4 < 3).select(
        "c_custkey", "c_nationkey", "c_name", "c_acctbal")
    null_row = t.customer.filter(F.col("c_custkey") == 1).select(
        F.lit(None).cast("long").alias("c_custkey"), "c_nationkey",
        F.lit("null-key target").alias("c_name"), "c_acctbal")
    return c.unionByName(null_row)


def upsert_staging(t: Tables) -> DataFrame:
    c = t.customer.filter(F.col("c_custkey") % 4 >= 2).select(
        "c_custkey", "c_nationkey", "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    null_row = t.customer.filter(F.col("c_custkey") == 2).select(
        F.lit(None).cast("long").alias("c_custkey"), "c_nationkey",
        F.lit("null-key staging").alias("c_name"), "c_acctbal")
    return c.unionByName(null_row)
