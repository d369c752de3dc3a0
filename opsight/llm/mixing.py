"""Mixing sources to target weights, in DataFrame operations only.

Tokens (words) of each source are packed into blocks of ``BLOCK`` tokens: documents stand in the order
of a hash bucket, then doc_id, and their running token offsets give the blocks that they cover. A
source's slots number its target: each whole pass takes every block once, and the last pass stops at
the target. Every slot draws its output shard, so a shard's source counts are one multinomial draw
whose totals over the shards are exactly the targets (independent draws would miss them by their
noise, and could take a block a third time). Within a pass, slot numbers go through the source's
pseudorandom index permutation, and the resulting block indexes are joined with the blocks.

All draws are hashes of a seed, so reruns agree. NULL and blank texts have size 0 and are never
taken; the NULL source is a source of its own; repeated doc_ids are told apart by a copy number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsight.llm.common import SEPARATORS, flag_rows, let, shared_table, words_of

BLOCK = 256
SHARD_SLOTS = 4096
SHARE = 1.5
WEIGHTS = (5, 2, 1)  # repeated over the sources, by code point, NULL last
EPOCHS = 2
SEED = 20240501
ROUNDS = 24
_CHUNK = 4096
_TASK_CHUNKS = 16


def _copy_numbers(docs: DataFrame, order: list[Column]) -> DataFrame:
    """``docs`` with ``__copy``: 1, or the row's place among rows of the same doc_id (only these are shuffled)."""
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    flagged = flag_rows(docs, ["doc_id"], repeated, "__repeated")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(*order))
    return (flagged.filter("not __repeated").withColumn("__copy", F.lit(1))
            .unionByName(flagged.filter("__repeated").withColumn("__copy", place))).drop("__repeated")


def source_targets(sizes: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS,
                   epochs: int = EPOCHS) -> DataFrame:
    """``(source, sid, source_size, target)``: weights share ``share`` of all sizes; a target stops at
    ``epochs`` times its source's size, and the excess goes to the others by weight.

    With sources in the order of size to weight, the first ones are full. The level (words for each
    unit of weight) follows from how many are; windows run over one row for each source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = per.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") - 1) % len(weights))
    rows = ordered.withColumn("w", w).withColumn("full", epochs * F.col("source_size").cast("double"))
    by_ratio = Window.orderBy(F.col("full") / F.col("w"), "sid")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy(F.lit(1))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * share - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
             / F.sum("w").over(after))
    rows = rows.withColumn("level", level).withColumn("place", F.row_number().over(by_ratio))
    fits = F.when(F.col("level") <= F.col("full") / F.col("w"), F.struct("place", "level"))
    rows = rows.withColumn("level", F.min(fits).over(everything)["level"])  # of the first source that is not full
    return rows.select("source", "sid", "source_size", F.coalesce(
        F.least("full", F.col("level") * F.col("w")), F.col("full")).alias("target"))


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0..n-1 (swap-or-not rounds, any n): a bijection for each key."""
    def step(x: Column, k: Column) -> Column:
        turn = F.pmod(F.xxhash64(F.lit(SEED), k, *key), n)
        return let(F.pmod(turn - x, n), lambda y: F.when(
            F.xxhash64(F.lit(SEED + 1), k, F.greatest(x, y), *key) % 2 == 0, y).otherwise(x))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, step)


def slots(sources: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``(sid, pass, shard, block, upto)``: each slot's block and how many of its tokens are taken."""
    s = (sources.filter("source_size > 0")
         .withColumn("want", F.least(F.round("target").cast("long"), EPOCHS * F.col("source_size")))
         .withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
         .withColumn("passes", F.expr("want div source_size")).withColumn("rest", F.expr("want % source_size"))
         .withColumn("n", F.expr(f"passes * blocks + (rest + {block - 1}) div {block}")))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    s = s.withColumn("shards", F.greatest(F.lit(1), F.ceil(total / shard_slots))).filter("n > 0")
    # a number, as the few narrow rows that the slots are made from would else be merged into one task
    tasks = -(-(s.agg(F.sum("n")).first()[0] or 0) // (_TASK_CHUNKS * _CHUNK))
    chunks = (s.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {_CHUNK}"))))
              .repartition(max(1, tasks), "sid", "chunk"))
    drawn = (chunks.withColumn("slot", F.explode(F.expr(
        f"sequence(chunk * {_CHUNK}, least(n, (chunk + 1) * {_CHUNK}) - 1)")))
        .withColumn("shard", F.expr(f"pmod(xxhash64({SEED + 2}, sid, slot), shards)"))
        .withColumn("pass", F.expr("slot div blocks")).withColumn("at", F.expr("slot % blocks")))
    # the last block may be short: it keeps its place, so every earlier place holds a whole block
    index = F.when(F.col("at") == F.col("blocks") - 1, F.col("at")).otherwise(
        permuted(F.col("at"), F.greatest(F.col("blocks") - 1, F.lit(1)), F.col("sid"), F.col("pass")))
    length = F.expr(f"least({block}, source_size - at * {block})")
    upto = F.when(F.col("pass") < F.col("passes"), length).otherwise(
        F.least(length, F.expr(f"rest - at * {block}")))
    return drawn.select("sid", "pass", "shard", index.alias("block"), upto.alias("upto"))


def shard_counts(drawn: DataFrame) -> DataFrame:
    """The multinomial draw itself: slots of each source in each output shard."""
    return drawn.groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("slots"), F.sum("upto").alias("tokens"))


def pack(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(placed, sources)``: every document's size and first token offset in its source, and the targets."""
    size = F.size(words_of(F.col("text"))).cast("long")
    rows = docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("h"))
    rows = shared_table(rows, "sizes")
    sizes = _copy_numbers(rows, [F.col("h"), F.col("source")]).drop("h")
    sources = shared_table(source_targets(sizes), "targets")
    buckets = max(1, math.isqrt(rows.count()))
    bucketed = (sizes.join(sources.select("source", "sid").withColumnRenamed("source", "of"),
                           F.col("source").eqNullSafe(F.col("of"))).drop("of")
                .withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(buckets))))
    bucketed = shared_table(bucketed, "bucketed")
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = (bucketed.groupBy("sid", "bucket").agg(F.sum("size").alias("total"))
             .select("sid", "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))
    inside = (Window.partitionBy("sid", "bucket").orderBy("doc_id", "__copy")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (bucketed.withColumn("upto", F.sum("size").over(inside)).join(heads, ["sid", "bucket"])
              .select("doc_id", "__copy", "sid", "size", (F.col("base") + F.col("upto") - F.col("size")).alias("start")))
    return shared_table(placed, "placed"), sources


def taken_ranges(placed: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(doc_id, __copy, pass, shard, first, last)``: the token ranges of each document that the mix takes."""
    segments = (placed.filter("size > 0")
                .withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
                .withColumn("a", F.expr(f"greatest(start - block * {block}, 0)"))
                .withColumn("b", F.expr(f"least(start + size - block * {block}, {block})")))
    # slots outgrow the few rows they are made from: without the hint the planner would broadcast them
    hit = segments.join(slots(sources, block).hint("merge"), ["sid", "block"]).withColumn("b", F.least("b", "upto")).filter("a < b")
    shift = F.expr(f"block * {block} - start")
    return hit.select("doc_id", "__copy", "pass", "shard", (F.col("a") + shift).alias("first"), (F.col("b") + shift).alias("last"))


def mix_report(docs: DataFrame) -> DataFrame:
    """Each document's size, its source's size and target, and the words that the mix takes of it."""
    placed, sources = pack(docs.select("doc_id", "text", "source"))
    sums = (taken_ranges(placed, sources).groupBy("doc_id", "__copy")
            .agg(F.sum(F.col("last") - F.col("first")).alias("taken")).withColumnRenamed("doc_id", "id")
            .withColumnRenamed("__copy", "c"))
    return (placed.join(sums, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("__copy") == F.col("c")), "left")
            .join(sources, "sid").select("doc_id", "size", "source_size", "target",
                                         F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: for each document and pass the part of its text that the mix takes.

    A part that covers the document is its whole text; else its taken words with the white space
    before them. ``n_chars`` is the length of the part; the other columns are the document's.
    """
    placed, sources = pack(docs.select("doc_id", "text", "source"))
    parts = (taken_ranges(placed, sources).groupBy("doc_id", "__copy", "pass")
             .agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("__ranges"))
             .select(F.col("doc_id").alias("__id"), F.col("__copy").alias("__c"), "__ranges"))
    # the rows as one column, whatever the names of their own columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", F.xxhash64("text").alias("h"))
    keyed = _copy_numbers(packed, [F.col("h"), F.col("source")])
    hit = keyed.join(parts, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__copy") == F.col("__c")))
    text = F.col("row.text")
    covered = F.aggregate("__ranges", F.lit(0).cast("long"), lambda s, r: s + r["last"] - r["first"])
    pieces = F.regexp_extract_all(text, F.lit(f"(?:{SEPARATORS})?[^\\x20\\x09-\\x0D]+"), F.lit(0))
    cut = let(pieces, lambda p: F.array_join(F.flatten(F.transform("__ranges", lambda r: F.slice(
        p, (r["first"] + 1).cast("int"), (r["last"] - r["first"]).cast("int")))), ""))
    row = F.col("row").withField("text", F.when(covered >= F.size(words_of(text)), text).otherwise(cut))
    out = hit.select(row.alias("row"))
    if "n_chars" in docs.columns:
        out = out.select(F.col("row").withField("n_chars", F.length("row.text").cast(docs.schema["n_chars"].dataType)).alias("row"))
    return out.select("row.*")
