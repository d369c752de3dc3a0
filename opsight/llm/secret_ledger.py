"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Every version of a text is a blob named by its SHA-256. The ledger lists the (blob, rule version)
pairs that have been scanned; a run scans only unseen pairs, appends them, and joins the findings of
a blob back to all paths that hold it. Spans are code-point offsets, end exclusive. NULL texts are
empty; empty texts hold no secrets and still get a row; repeated rows repeat their result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsight.llm.common import flag_rows, let, rows_not_in, shared_table


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` finds candidates, leftmost and non-overlapping; a candidate counts if its text
    (or, where ``value`` is set, the value after the separator) has at least ``least`` characters."""
    kind: str
    version: int
    pattern: str
    least: int = 0
    value: str | None = None


# The base kinds, in the order in which spans at one start are listed.
_KEY = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    SecretRule("assign", 1, _KEY + r"[A-Za-z0-9+/_.=-]+", 6, _KEY),
    SecretRule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", 1, r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    SecretRule("private_key", 1, r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    SecretRule("hosted_token", 1, r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})"),
    # a token or scheme is looked for at the start of its run of characters only, so every run is read once
    SecretRule("web_token", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    SecretRule("url_password", 3, r"(?<![a-z0-9+.-])[a-z0-9+.-]++(?<=[a-z0-9])://[^\s/:@]++:[^\s/:@]{3,}+@"),
)
RULES = BASE_RULES + MORE_RULES
BLOCK = 256  # matches whose offsets are summed up in one array


def rule_spans(text: Column, rule: SecretRule) -> Column:
    """Array of (start, end, place) of the rule's findings: the lengths of the gaps between matches and
    of the matches give their offsets."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    span = "struct<start:int,end:int,value:int>"

    def block(steps: Column) -> Column:  # offsets from the start of a block of matches
        end = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("found"))
        return F.aggregate(steps, end, lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["n"]).alias("at"),
            F.concat(acc["found"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["n"]).alias("end"), x["value"].alias("value")))).alias("found")))

    def shifted(blocks: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("bases"))
        bases = F.aggregate(blocks, begin, lambda acc, x: F.struct(
            (acc["at"] + x["at"]).alias("at"), F.concat(acc["bases"], F.array(acc["at"])).alias("bases")))["bases"]
        return F.flatten(F.zip_with(blocks, bases, lambda x, o: F.transform(x["found"], lambda y: F.struct(
            (y["start"] + o).alias("start"), (y["end"] + o).alias("end"), y["value"].alias("value")))))

    def placed(m: Column) -> Column:
        def walk(g: Column) -> Column:
            steps = F.zip_with(F.slice(g, F.lit(1), F.size(m)), m, lambda gap, hit: F.struct(
                F.length(gap).alias("gap"), F.length(hit).alias("n"), _length(hit, rule).alias("value")))
            # in blocks, as appending to one array copies it each time
            blocks = let(steps, lambda all_steps: F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / BLOCK).cast("int")),
                                                              lambda k: block(F.slice(all_steps, k * BLOCK + 1, BLOCK))))
            return let(blocks, shifted)
        return let(F.split(text, rule.pattern, -1), walk)

    found = F.when(text.rlike(rule.pattern), let(matches, placed))
    kept = F.filter(found, lambda x: x["value"] >= rule.least)
    return F.transform(F.coalesce(kept, F.array()), lambda x: F.struct(
        x["start"].alias("start"), F.lit(RULES.index(rule) if rule in RULES else len(RULES)).alias("place"),
        x["end"].alias("end"), F.lit(rule.kind).alias("kind")))


def _length(hit: Column, rule: SecretRule) -> Column:
    return F.length(F.regexp_replace(hit, "^" + rule.value, "")) if rule.value else F.length(hit)


def empty_ledger(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame(
        [], "blob string, kind string, version int, spans array<struct<start:int,place:int,end:int,kind:string>>")


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[SecretRule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """``(paths, ledger)``: each row's ``doc_id, blob``, and the ledger with the pairs that were unseen.

    ``docs(doc_id, text)`` holds the versions of this run. One document stands for each blob, unrepeated texts are not shuffled, and only
    blobs with an unseen rule version are scanned, for these rules only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    paths = shared_table(docs.select("doc_id", F.sha2(text, 256).alias("blob")), "paths")
    chosen = shared_table(paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("times")), "blobs")
    every = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
    if ledger is None:  # all blobs are unseen: only the other rows of repeated ones are taken out
        first = chosen.filter("times > 1").select("blob", F.col("doc_id").alias("of"))
        repeats = paths.join(first, "blob").filter("not doc_id <=> of").select("blob", "doc_id").distinct()
        own = rows_not_in(_blobs(docs), ["blob", "doc_id"], shared_table(repeats, "repeats")).withColumn("todo", every)
    else:
        done = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("done"))  # a blob's few rules
        todo = (chosen.join(done, "blob", "left")
                .select("blob", F.col("doc_id").alias("of"), F.array_except(every, F.coalesce("done", F.array())).alias("todo")))
        todo = shared_table(todo.filter("size(todo) > 0"), "unseen")
        maybe = flag_rows(_blobs(docs), ["blob"], todo, "maybe").filter("maybe")
        own = maybe.join(todo, "blob").filter("doc_id <=> of").select("doc_id", "text", "blob", "todo")
    found = scan_blobs(own, rules)
    return paths, found if ledger is None else ledger.unionByName(found)


def _blobs(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.sha2(text, 256).alias("blob"))


def scan_blobs(own: DataFrame, rules: tuple[SecretRule, ...]) -> DataFrame:
    """Ledger rows of ``own(text, blob, todo)``, scanned for the rule versions in ``todo``."""
    text = F.col("text")
    wanted = lambda r: F.array_contains("todo", f"{r.kind}:{r.version}")
    spans = F.array(*[F.when(wanted(r), F.struct(
        F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), rule_spans(text, r).alias("spans"))) for r in rules])
    # a repeated row of a document scans its blob twice; findings() removes equal spans
    return shared_table(own.select("blob", F.explode(F.array_compact(spans)).alias("x"))
                        .select("blob", "x.kind", "x.version", "x.spans"), "scanned")


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Each path's spans of the given rule versions, sorted by start, then rule order."""
    current = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
    of_blob = (ledger.filter("size(spans) > 0")
               .filter(F.array_contains(current, F.concat_ws(":", "kind", "version")))
               .groupBy("blob").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")))
    of_blob = shared_table(of_blob, "of_blob")  # no aggregate before the join, so that a blob of many paths is split
    return paths.join(of_blob, "blob", "left").withColumn("spans", F.coalesce("spans", F.array()))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts and digests of every document's findings, from a scan with a new ledger."""
    paths, ledger = scan(docs)
    out = findings(paths, ledger)
    base = F.filter("spans", lambda x: x["place"] < len(BASE_RULES))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return out.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES],
                      F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), "blob")
