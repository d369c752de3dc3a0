"""Quality rules as a learned decision list, in DataFrame operations only.

Sequential covering: each rule is a conjunction of thresholds on document statistics, grown on two
thirds of the labelled documents by FOIL gain, pruned on the rest, and kept while its precision on
both parts is high; the documents that it covers then leave the training set. The rules become one
ordered conditional expression, so applying them is a projection without any shuffle.

The only bounded step is the fit: at most ``SAMPLE_ROWS`` labelled documents (lowest hash of the
doc_id). Statistics and verdicts cover every whole text. NULL and blank texts have no words and fail
the base rule. Repeated rows are judged alike, repeated labels of a document count as its best one.
Without labels of both kinds there are no rules, and the base rule alone decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsight.llm.common import SEPARATORS, let, shared_table, words_of

SAMPLE_ROWS = 12_000
MAX_CONDITIONS = 4
MAX_RULES = 12
MIN_COVER = 5
MIN_PRECISION = 0.95
GRID = 24  # a feature's thresholds lie midway between so many quantiles of either class

FEATURES = ("n_words", "mean_word", "symbol_share", "upper_share", "exclaim_share", "bar_share",
            "digit_share", "dup_line_share", "repeat_share")
STATS = "__quality"


# Up to so many different repeated windows are looked up one by one, more by sorting (same result).
_FEW = 24


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur at least twice in the text, the first included.

    Windows are 64-bit hashes of their words; a text without equal hashes has no repeats.
    """
    def covered(at: Column) -> Column:
        return let(at, lambda a: F.aggregate(  # windows that overlap count their words once
            F.transform(a, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(a, j + 1) - x, F.lit(3)))),
            F.lit(0), lambda total, x: total + x))

    def by_sorting(g: Column) -> Column:
        def kept(p: Column) -> Column:
            same = F.transform(p, lambda x, j: F.when(
                F.get(p, j - 1)["s"].eqNullSafe(x["s"]) | F.get(p, j + 1)["s"].eqNullSafe(x["s"]), x["i"]))
            return covered(F.sort_array(F.array_compact(same)))
        return let(F.sort_array(F.transform(g, lambda s, i: F.struct(s.alias("s"), i.alias("i")))), kept)

    def in_windows(g: Column) -> Column:
        def repeated(s: Column) -> Column:
            twice = F.array_distinct(F.array_compact(F.transform(s, lambda x, j: F.when(F.get(s, j + 1) == x, x))))
            return let(twice, lambda r: F.when(F.size(r) > _FEW, by_sorting(g)).otherwise(covered(F.array_compact(
                F.transform(g, lambda x, i: F.when(F.array_contains(r, x), i))))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(F.sort_array(g), repeated))

    windows = F.slice(F.transform(words, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2))),
                      F.lit(1), F.size(words) - 2)
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(windows, in_windows))


def _left(text: Column, others: str) -> Column:
    """Characters that remain when those of the class ``others`` are taken away."""
    return F.length(F.regexp_replace(text, others, ""))


def statistics(text: Column) -> Column:
    """A struct of the base counts and of the features of a text."""
    t = F.coalesce(text, F.lit(""))
    of_words = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words")))
    # signs, digits and capitals are counted in what remains without small letters and white space
    rest = F.regexp_replace(t, r"[a-z\x20\x09-\x0D]+", "")
    signs = let(rest, lambda z: F.struct(
        _left(z, r"[^#*$%&|<>]+").cast("long").alias("n_symbols"), _left(z, r"\P{Lu}+").alias("n_upper"),
        _left(z, r"[^0-9]+").alias("n_digits"), _left(z, r"[^!]+").alias("n_exclaim"), _left(z, r"[^|]+").alias("n_bars")))
    lines = let(F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                lambda x: F.struct(F.size(x).alias("n_lines"),
                                   (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return F.struct(
        of_words.alias("words"), lines.alias("lines"),
        signs.alias("signs"), _left(t, SEPARATORS).cast("long").alias("word_chars"))


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct column ``__quality``: base counts, ``base_failed`` and the features."""
    s = F.col(STATS)
    chars = F.greatest(s["word_chars"], F.lit(1)).cast("double")
    n = F.greatest(s["words"]["n_words"], F.lit(1)).cast("double")
    n_words, repeats = s["words"]["n_words"], s["words"]["n_repeat_words"]
    return docs.withColumn(STATS, statistics(F.col("text"))).withColumn(STATS, F.struct(
        n_words.alias("n_words"), s["word_chars"].alias("word_chars"), s["signs"]["n_symbols"].alias("n_symbols"),
        s["lines"]["n_dup_lines"].alias("n_dup_lines"), repeats.alias("n_repeat_words"),
        ((n_words < 50) | (100 * repeats > 50 * n_words)).alias("base_failed"),
        F.array(n_words.cast("double"), chars / n, s["signs"]["n_symbols"] / chars, s["signs"]["n_upper"] / chars,
                s["signs"]["n_exclaim"] / chars, s["signs"]["n_bars"] / chars, s["signs"]["n_digits"] / chars,
                s["lines"]["n_dup_lines"] / F.greatest(s["lines"]["n_lines"], F.lit(1)),
                repeats / n).alias("features")))


@dataclass(frozen=True)
class Condition:
    feature: int
    above: bool
    threshold: float

    def holds(self, features: Column) -> Column:
        value = F.get(features, F.lit(self.feature))
        return (value > self.threshold) if self.above else (value <= self.threshold)

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _fires(rule: Rule, features: Column) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.holds(features)
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -math.inf


def _grow(rows: DataFrame, thresholds: list[list[float]], p0: int, n0: int) -> Rule:
    """Conditions added one by one; each step counts all (feature, interval, class) cells in one job."""
    rule: Rule = ()
    grid = F.array(*[F.array(*[F.lit(float(t)) for t in ts]).cast("array<double>") for ts in thresholds])
    while len(rule) < MAX_CONDITIONS and n0:
        cells: dict[tuple[int, int], list[int]] = {}
        binned = (rows.filter(_fires(rule, F.col("features")))
                  .select("reject", F.posexplode(F.zip_with(
                      "features", grid, lambda v, ts: F.size(F.filter(ts, lambda t: t < v)))).alias("f", "bin"))
                  .groupBy("f", "bin").agg(F.sum("reject").alias("p"), F.sum(1 - F.col("reject")).alias("n")))
        for r in binned.collect():  # at most one row for each feature and interval
            cells[r["f"], r["bin"]] = [r["p"], r["n"]]
        best: tuple[float, Condition, int, int] | None = None
        for f, ts in enumerate(thresholds):
            p = n = 0
            for k, t in enumerate(ts):
                dp, dn = cells.get((f, k), (0, 0))
                p, n = p + dp, n + dn
                for above, a, b in ((False, p, n), (True, p0 - p, n0 - n)):
                    gain = _gain(a, b, p0, n0)
                    if a >= MIN_COVER and (best is None or gain > best[0]):
                        best = (gain, Condition(f, above, t), a, b)
        if best is None or best[0] <= 1e-9:
            break
        rule, p0, n0 = (*rule, best[1]), best[2], best[3]
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The shortest beginning of the rule with the best (p - n) / (p + n) on the pruning part."""
    sums = []
    for k in range(1, len(rule) + 1):
        fires = _fires(rule[:k], F.col("features"))
        sums += [F.sum(F.when(fires, F.col("reject"))).alias(f"p{k}"), F.sum(F.when(fires, 1 - F.col("reject"))).alias(f"n{k}")]
    row = rows.agg(*sums).first()
    scored = [((p - n) / (p + n) if p + n else -1.0, -k, p, n)
              for k in range(1, len(rule) + 1) for p, n in [(row[f"p{k}"] or 0, row[f"n{k}"] or 0)]]
    _, k, p, n = max(scored)
    return rule[:-k], p, n


def learn_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Ordered reject rules from ``labels(doc_id, quality)`` (quality 0: reject) of documents that pass the base."""
    chosen = (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
              .agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    known = with_statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    rows = shared_table(known.filter(f"not {STATS}.base_failed").select(
        (F.col("quality") == 0).cast("long").alias("reject"), F.col(f"{STATS}.features").alias("features"),
        (F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(3)) > 0).alias("growing")), "labelled")
    cuts = [F.percentile_approx(F.when(F.col("reject") == k, F.get("features", F.lit(f))),
                                [(i + 0.5) / GRID for i in range(GRID)], 10_000).alias(f"c{k}_{f}")
            for k in (0, 1) for f in range(len(FEATURES))]
    row = rows.agg(*cuts).first()
    values = [sorted({*(row[f"c0_{f}"] or ()), *(row[f"c1_{f}"] or ())}) for f in range(len(FEATURES))]
    thresholds = [[(a + b) / 2 for a, b in zip(v, v[1:])] for v in values]  # midway, so that neither class sits on one
    rules: list[Rule] = []
    rest = rows
    while len(rules) < MAX_RULES:
        counts = {r["growing"]: (r["p"], r["n"]) for r in rest.groupBy("growing").agg(
            F.sum("reject").alias("p"), F.sum(1 - F.col("reject")).alias("n")).collect()}
        p0, n0 = counts.get(True, (0, 0))
        if p0 < MIN_COVER or not n0 or not counts.get(False, (0, 0))[0]:
            break
        rule = _grow(rest.filter("growing"), thresholds, p0, n0)
        if not rule:
            break
        rule, p, n = _prune(rest.filter("not growing"), rule)
        on = rest.filter("growing").filter(_fires(rule, F.col("features"))).agg(
            F.sum("reject").alias("p"), F.sum(1 - F.col("reject")).alias("n")).first()
        p, n = p + (on["p"] or 0), n + (on["n"] or 0)
        if p < MIN_COVER or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule)
        rest = rest.filter(~_fires(rule, F.col("features")))
    return rules


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with ``__quality``, whose fields now include ``rule`` (the first that fires) and ``kept``."""
    features = F.col(f"{STATS}.features")
    fired = F.lit(None).cast("string")
    for rule in reversed(rules):
        fired = F.when(_fires(rule, features), F.lit(" and ".join(map(str, rule)))).otherwise(fired)
    return with_statistics(docs).withColumn(
        STATS, F.col(STATS).withField("rule", F.when(~F.col(f"{STATS}.base_failed"), fired))) \
        .withColumn(STATS, F.col(STATS).withField(
            "kept", ~F.col(f"{STATS}.base_failed") & F.col(f"{STATS}.rule").isNull()))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, base verdict and final verdict of each document."""
    docs = docs.select("doc_id", "text")
    out = judged(docs, learn_rules(docs, labels))
    return out.select("doc_id", *[f"{STATS}.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")])


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the base rule and the learned rules keep, with their own columns."""
    # the rows as one column, whatever the names of their own columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    rules = learn_rules(docs.select("doc_id", "text"), labels)
    return judged(packed, rules).filter(f"{STATS}.kept").select("row.*")
