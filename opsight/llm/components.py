"""Links found through shared signatures, without forming all pairs of a bucket, and connected components.

Both work on tables that Spark shuffles; nothing but a count reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsight.llm.common import release, rows_in, shared_table


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``edges(a, b)``; the component is its smallest id.

    Each round takes the smallest label among a node's neighbours and then the label of that label,
    so a chain of n links needs about log n rounds. Every round is a written table.
    """
    both = shared_table(edges.select("a", "b").union(edges.select("b", "a")).distinct().toDF("id", "other"), "edges")
    labels = shared_table(both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("component")), "labels")
    while True:
        seen = (both.join(labels.withColumnRenamed("id", "other"), "other")
                .groupBy("id").agg(F.min("component").alias("near")))
        step = labels.join(seen, "id").select("id", "component", F.least("component", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("component").alias("lower"))
        after = shared_table(step.join(jump, "low", "left")
                             .select("id", F.col("component").alias("was"),
                                     F.least("low", "lower").alias("component")), "labels")
        release(labels)
        labels = after.select("id", "component")
        if after.filter("component <> was").limit(1).count() == 0:
            release(both)
            return labels


def joined_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components of the links of ``found(id, component)`` and of ``links(a, b)``: only what the new links
    connect, components and new ids, is searched."""
    ends = links
    for end in ("a", "b"):
        ends = (ends.join(found.select(F.col("id").alias(end), "component"), end, "left")
                .withColumn(end, F.coalesce("component", end)).drop("component"))
    step = connected_components(shared_table(ends.filter("a <> b").distinct(), "ends"))
    old = (found.join(step.select(F.col("id").alias("component"), F.col("component").alias("joined")), "component", "left")
           .select("id", F.coalesce("joined", "component").alias("component")))
    return shared_table(old.unionByName(step.join(found.select("id"), "id", "left_anti")), "components")


PART = 2048  # members of a bucket for each part that is compared with the whole bucket

# Two members can share 4/9 of their sizes' sum (similarity 0.8) only if the parts that others share allow it.
_MAY_LINK = ("5 * least(size, {0}size) >= 4 * greatest(size, {0}size) "
             "and 9 * least(usable, {0}usable) >= 4 * (size + {0}size)")
# What both share with their bucket's pivot, and what either shares with others beyond it, bounds it further.
_MAY_LINK_BY_PIVOT = ("(near is null or o_near is null or 9 * (least(near, o_near) "
                      "+ least(usable - near, o_usable - o_near)) >= 4 * (size + o_size))")


def links_from_buckets(postings: DataFrame, verify: Callable[[DataFrame], DataFrame],
                       star_rounds: int = 2, details: DataFrame | None = None, may_link: str = "true",
                       alone: bool = True) -> tuple[DataFrame, DataFrame]:
    """Connected ``(id, component)`` of all ids that share a signature and pass ``verify``, and the links.

    ``postings(sig, id, size, rank, usable)`` lists the ids of each signature; ``usable`` is how much of
    an id's size any other id may share. ``verify`` takes pairs ``(a, b)`` and returns ``(a, b, shared,
    link)``, ``shared`` being the pair's overlap if it is a set join's, else NULL.

    Forming all pairs of a bucket is quadratic in its members, so first each member is compared with its
    bucket's pivot (lowest ``rank``, then id), then with the lowest member outside that pivot's component.
    What then lies in one component needs no further comparison; the last round compares all members of
    a bucket that are still in different components, unless their overlaps with the pivot show that they
    cannot link. So no link between components is lost, whatever the bucket's size. ``details(id, ...)`` adds columns
    to the members of that round, and ``may_link`` is false only for pairs whose columns (``o_...`` of the second)
    show that they cannot link; such pairs are no rows. Where no row of ``postings`` is ``alone`` with its signature or
    there twice, it is not looked for such.
    """
    opened = postings.select("sig", "id", "size", "rank", "usable")
    if alone:
        keys = (postings.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("sig"))
        opened = opened.join(keys, "sig", "left_semi").distinct()
    opened = shared_table(opened, "members")
    rows = opened.withColumn("near", F.lit(None).cast("long"))
    spark, id_type = postings.sparkSession, postings.schema["id"].dataType.simpleString()
    links = spark.createDataFrame([], f"a {id_type}, b {id_type}")
    tested = spark.createDataFrame([], f"a {id_type}, b {id_type}")
    found = spark.createDataFrame([], f"id {id_type}, component {id_type}")
    lowest = F.min(F.struct("rank", "id", "size", "usable", "component")).alias("p")
    for k in range(star_rounds + 1):
        labelled = rows.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = (labelled.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                 .filter("low <> high").select("sig"))
        rows = shared_table(labelled.join(mixed, "sig", "left_semi"), "open")
        release(opened)  # the table before this one; results and pairs are still read
        opened = rows
        pivots = rows.groupBy("sig").agg(lowest)
        if k == 1:  # the first pivot has met all members: take the lowest outside its component
            pivots = rows.join(pivots, "sig").filter("component <> p.component").groupBy("sig").agg(lowest)
        if k < star_rounds:
            pairs = (rows.join(pivots, "sig").filter("component <> p.component and " + _MAY_LINK.format("p."))
                     .select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b")))
        else:
            # a pair that shares several signatures is formed at the smallest only
            lists = rows.groupBy("id").agg(F.collect_set("sig").alias("sigs"))  # an id's own signatures
            # members of a large bucket are dealt out in parts, each of which meets all others
            parts = rows.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
            listed = rows.join(lists, "id").join(parts, "sig")
            if details is not None:
                listed = listed.join(rows_in(details, ["id"], lists.select("id"), unique=True), "id")
            listed = shared_table(listed, "listed", "zstd")
            other = listed.drop("parts").toDF(*[c if c == "sig" else f"o_{c}" for c in listed.columns if c != "parts"])
            other = other.join(parts.filter("parts > 1"), "sig", "left").withColumn("part", F.expr("explode(sequence(0, coalesce(parts, 1) - 1))"))
            listed = listed.withColumn("part", F.expr("pmod(hash(id), parts)"))
            pairs = (listed.join(other.drop("parts"), ["sig", "part"])
                     .filter("component < o_component and " + _MAY_LINK.format("o_") + " and " + _MAY_LINK_BY_PIVOT
                             + " and " + may_link + " and sig = array_min(array_intersect(sigs, o_sigs))")
                     .select(F.least("id", "o_id").alias("a"), F.greatest("id", "o_id").alias("b")))
        pairs = shared_table(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        if pairs.limit(1).count():
            tested = tested.unionByName(pairs)
            results = shared_table(verify(pairs), "results")
            if not k:
                near = (rows.join(pivots.select("sig", F.col("p.id").alias("pivot")), "sig")
                        .withColumn("a", F.least("id", "pivot")).withColumn("b", F.greatest("id", "pivot"))
                        .join(results.select("a", "b", "shared"), ["a", "b"], "left")
                        .withColumn("near", F.when(F.col("id") == F.col("pivot"), F.col("size")).otherwise(F.col("shared"))))
                rows = near.select("sig", "id", "size", "rank", "usable", "near", "component")
            new = results.filter("link").select("a", "b")
            if new.limit(1).count():
                links = links.unionByName(new)
                found = joined_components(found, new) if k else connected_components(new)
        rows = rows.drop("component")
    return found, links


def fetch(table: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ``key`` is in ``ids(id)``; other rows are dropped before any shuffle."""
    return rows_in(table, [key], ids.select(F.col("id").alias(key)))
