"""URL filter: fixed host rules, and association rules mined from labelled URLs.

The fixed rules (host plus path beginning, longest wins) label the URLs that they fit. FP-growth
over Spark tables mines token combinations of these URLs (host labels, host suffixes, path parts, file
endings, query keys) with their counts by label; combinations that imply a label with
enough support and confidence become rules, unless a part of the combination already does as well.
A URL without a fixed rule is matched by inverted index: each mined rule is listed under its rarest
token, and its other tokens are checked on the candidates. The best match decides; without one, the
verdict is allow.

NULL URLs and URLs without ``://`` have an empty host and path, fit no rule and are allowed. Repeated
rows are judged alike. Without labels there are no mined rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsight.llm.common import shared_table

# The contract's rules.
HOST_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
              ("block", "net", "/es/"), ("block", "net", "/fr/"))
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8
MIN_MATCHES = 5


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty when there is no ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://(?s:(.*))$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column) -> Column:
    """The longest fitting fixed rule as a struct (verdict, rule), else NULL."""
    out = F.lit(None)
    for verdict, domain, start in sorted(HOST_RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(domain + start).alias("rule"))).otherwise(out)
    return out


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """The distinct tokens of a URL."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.concat(
        F.lit("domain="), F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    parts = F.filter(F.split(F.lower(path), "/"), lambda x: x != "")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.filter(F.split(query, "&"), lambda x: x != "")
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(
        F.when(F.size(labels) > 0, F.concat(F.transform(labels, lambda x: F.concat(F.lit("host="), x)), suffixes)).otherwise(none),
        F.transform(parts, lambda x: F.concat(F.lit("path="), x)),
        F.transform(keys, lambda x: F.concat(F.lit("key="), F.regexp_extract(x, "^([^=]*)", 1))),
        F.when(ending != "", F.array(F.concat(F.lit("ending="), F.lower(ending)))).otherwise(none),
        F.when(path.endswith("/"), F.array(F.lit("path ends with /"))).otherwise(none)))


def judged_urls(pages: DataFrame) -> DataFrame:
    host, path = url_parts(F.col("url"))
    return (pages.withColumn("host", host).withColumn("path", path)
            .withColumn("fixed", fixed_rule(F.col("host"), F.col("path")))
            .withColumn("tokens", F.when(F.col("host") != "", url_tokens(
                F.col("host"), F.col("path"), F.col("url"))).otherwise(F.array().cast("array<string>"))))


def frequent_tokens(sets: DataFrame, least: Column) -> DataFrame:
    """``(token, n, per_verdict, item)``: the tokens of at least ``least`` rows of ``sets(tokens, verdict, w)``; tokens
    that occur in the very same sets (equal counts and sums of set hashes) share one ``item``, the longest of them."""
    each = sets.select(F.explode("tokens").alias("token"), "verdict", "w", F.xxhash64("tokens").alias("h"))
    per = each.groupBy("token", "verdict").agg(F.sum("w").alias("w"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"))
    found = (per.groupBy("token").agg(F.sum("w").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").alias("s"),
                                      F.collect_list(F.struct("verdict", "w")).alias("per_verdict"))  # one for each verdict
             .filter(F.col("n") >= least))
    alike = found.groupBy("n", "x", "s").agg(F.min(F.struct((-F.length("token")).alias("long"), "token"))["token"].alias("item"))
    return shared_table(found.join(alike, ["n", "x", "s"]).select("token", "n", "per_verdict", "item"), "tokens")


def grown_sets(rows: DataFrame, single: DataFrame, least: float) -> list[DataFrame]:
    """``(tokens, n, per_verdict)`` of the sets of two items, of three, ..., that at least ``least`` of the weights ``w``
    of ``rows(items, verdict, w)`` hold; ``single`` lists the items by themselves.

    FP-growth's conditional pattern bases, one shuffle for each size: for each set what follows it in the rows,
    equal ones counted. A set is left out only with all that contain it, and only where it can give no rule: if a part
    of it occurs in the very same rows, or in rows of one verdict only. So labels and domains that imply each other
    do not multiply the sets, and each is still combined with everything else.
    """
    def followed(base: DataFrame) -> DataFrame:
        each = base.select("prefix", F.posexplode("tail").alias("at", "t"), "tail", "verdict", "w")
        return shared_table(each.select(F.array_append("prefix", F.col("t")).alias("prefix"), F.expr("slice(tail, at + 2, size(tail))").alias("tail"), "verdict", "w")
                            .filter("size(tail) > 0").groupBy("prefix", "tail", "verdict").agg(F.sum("w").alias("w")), "bases")

    out = []
    base = followed(rows.select(F.array().cast("array<string>").alias("prefix"), F.sort_array("items").alias("tail"), "verdict", "w"))
    smaller = single.select("tokens", "n")
    while base.limit(1).count():
        counts = (base.select("prefix", F.explode("tail").alias("t"), "verdict", "w").groupBy("prefix", "t", "verdict").agg(F.sum("w").alias("w"))
                  .groupBy("prefix", "t").agg(F.sum("w").alias("n"), F.collect_list(F.struct("verdict", "w")).alias("per_verdict"))
                  .filter(F.col("n") >= least).withColumn("tokens", F.array_append("prefix", F.col("t"))))
        counts = shared_table(counts, "counts")
        parts = counts.select("tokens", "n", F.explode("tokens").alias("gone")).withColumn("part", F.array_remove("tokens", F.col("gone")))
        free = (parts.join(smaller.toDF("part", "m"), "part").filter("m > n")
                .groupBy("tokens").agg(F.count(F.lit(1)).alias("parts")).filter("parts = size(tokens)").select("tokens"))
        found = shared_table(counts.join(free, "tokens", "left_semi"), "sets")
        out.append(found.select("tokens", "n", "per_verdict"))
        mixed = found.filter("size(per_verdict) > 1")
        smaller = mixed.select("tokens", "n")
        after = mixed.groupBy("prefix").agg(F.collect_set("t").alias("next"))
        base = followed(base.join(after, "prefix").select("prefix", F.array_intersect("tail", "next").alias("tail"), "verdict", "w"))
    return out


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``(tokens, verdict, confidence, matches, alike)`` from ``labelled(tokens, verdict)``.

    Rules of one token are counted for every token. Longer ones come from :func:`grown_sets` over items, where tokens
    that always occur together are one; ``alike`` lists the tokens that each of a rule's tokens stands for, and a
    rule fits with any of them. A rule is kept when its confidence reaches ``min_confidence``, exceeds the label's
    share, and no rule for the same verdict with one token less has as high a confidence.
    """
    sets = shared_table(labelled.groupBy(F.array_sort("tokens").alias("tokens"), "verdict").agg(F.count(F.lit(1)).alias("w")), "labelled")
    total = sets.agg(F.sum("w")).first()[0] or 0
    least = float(max(min_support * total, MIN_MATCHES))
    share = sets.groupBy(F.col("verdict").alias("v")).agg((F.sum("w") / F.lit(max(total, 1))).alias("share"))
    tokens = frequent_tokens(sets, F.lit(least))
    mixed = tokens.filter((F.size("per_verdict") > 1) & (F.col("n") < total))
    listed = (sets.withColumn("token", F.explode("tokens")).join(mixed.select("token", "item"), "token")
              .groupBy("tokens", "verdict", "w").agg(F.collect_set("item").alias("items")))  # a set's own tokens
    rows = listed.groupBy(F.sort_array("items").alias("items"), "verdict").agg(F.sum("w").alias("w"))
    found = tokens.select(F.array("token").alias("tokens"), "n", "per_verdict")
    for more in grown_sets(rows, mixed.filter("token = item").select(F.array("item").alias("tokens"), "n"), least):
        found = found.unionByName(more)
    rules = (found.withColumn("p", F.explode("per_verdict"))
             .select("tokens", "p.verdict", (F.col("p.w") / F.col("n")).alias("confidence"), F.col("p.w").alias("matches"))
             .filter((F.col("matches") >= least) & (F.col("confidence") >= min_confidence)))
    rules = shared_table(rules.join(share, F.col("verdict") == F.col("v"), "left")
                         .filter("share is null or confidence > share").drop("v", "share"), "rules")
    shorter = (rules.filter("size(tokens) > 1").withColumn("gone", F.explode("tokens"))
               .withColumn("part", F.array_remove("tokens", F.col("gone"))))
    weaker = (shorter.join(rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("c")), ["part", "verdict"])
              .filter("c >= confidence").select("tokens", "verdict").distinct())
    kept = shared_table(rules.join(weaker, ["tokens", "verdict"], "left_anti"), "kept")
    forms = mixed.groupBy("item").agg(F.sort_array(F.collect_list(F.struct((-F.length("token")).alias("long"), "token")))["token"].alias("forms"))
    alike = (kept.filter("size(tokens) > 1").select("tokens", "verdict", F.posexplode("tokens").alias("at", "item")).join(forms, "item")
             .groupBy("tokens", "verdict").agg(F.sort_array(F.collect_list(F.struct("at", "forms")))["forms"].alias("alike")))
    return shared_table(kept.join(alike, ["tokens", "verdict"], "left")
                        .withColumn("alike", F.coalesce("alike", F.array("tokens"))), "kept")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(tokens, verdict)`` of each distinct token set in ``urls``: its best rule by confidence, matches, tokens.

    A rule is indexed under its rarest token (and those alike) only, so common tokens (a scheme, ``www``) form no
    hot list.
    """
    sets = urls.select("tokens").distinct()
    counts = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    forms = rules.select("tokens", "verdict", F.posexplode("alike").alias("at", "forms"))
    rarest = (forms.withColumn("token", F.explode("forms")).join(counts, "token")
              .groupBy("tokens", "verdict", "at").agg(F.sum("n").alias("n"))
              .groupBy("tokens", "verdict").agg(F.min(F.struct("n", "at"))["at"].alias("at"), F.count(F.lit(1)).alias("found"))
              .filter("found = size(tokens)"))
    index = (rules.join(rarest, ["tokens", "verdict"])
             .select(F.expr("explode(alike[at])").alias("token"), F.col("alike").alias("needed"), "verdict", "confidence", "matches"))
    hits = (sets.withColumn("token", F.explode("tokens")).join(index, "token")
            .filter(F.forall("needed", lambda x: F.arrays_overlap(x, "tokens"))))
    own = F.transform("needed", lambda x: F.get(F.array_intersect(x, F.col("tokens")), F.lit(0)))
    best = F.max(F.struct("confidence", "matches", F.size("needed").alias("n"), "verdict", F.array_join(own, " & ").alias("text")))
    return hits.groupBy("tokens").agg(best.alias("best")).select("tokens", F.col("best.verdict").alias("mined"), F.col("best.text").alias("mined_rule"))


def url_verdicts(pages: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of each page; ``mined_rule`` names the tokens that decided."""
    urls = shared_table(judged_urls(pages.select("page_id", "url")).drop("url"), "urls")
    labelled = urls.filter("fixed is not null").select("tokens", F.col("fixed.verdict").alias("verdict"))
    matched = match_rules(urls.filter("fixed is null"), mine_rules(labelled))
    out = urls.join(matched, "tokens", "left")
    return out.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"),
                      F.coalesce("fixed.verdict", "mined", F.lit("allow")).alias("verdict"),
                      F.when(F.col("fixed").isNull(), F.col("mined_rule")).alias("mined_rule"))
