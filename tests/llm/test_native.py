"""The operators that are DataFrame operations only, against plain Python."""

import duckdb
import pytest
from pyspark.sql import functions as F

import re

from opsight.llm import mixing, quality_rules, queries, secret_ledger
from tests.llm import brute


def _docs(folder):
    return duckdb.sql(f"select doc_id, text, source from '{folder}/documents.parquet' order by 1").fetchall()


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_base_counts(spark, folder, hard):
    got = {r.doc_id: tuple(r)[1:7] for r in queries.op8_quality_rules(spark, folder).collect()}
    assert got == {i: brute.quality_base(t) for i, t, _ in _docs(folder)}
    report = quality_rules.quality_report(hard, _labels(spark, []))
    got = {r.doc_id: tuple(r)[1:7] for r in report.collect()}
    assert got == {r.doc_id: brute.quality_base(r.text) for r in hard.collect()}


def test_quality_keeps_clean_documents(spark, folder):
    kept = {r.doc_id: (r.kept, r.base_failed) for r in queries.op8_quality_rules(spark, folder.replace("0.001", "0.01")).collect()}
    labels = duckdb.sql(f"select doc_id, quality from '{folder.replace('0.001', '0.01')}/labels.parquet'").fetchall()
    judged = [(q, kept[i][0]) for i, q in labels if not kept[i][1]]
    clean, junk = [k for q, k in judged if q == 1], [k for q, k in judged if q == 0]
    assert sum(clean) >= 0.98 * len(clean)
    assert sum(junk) <= 0.3 * len(junk)


def test_quality_without_labels_or_documents(spark, hard, empty):
    assert quality_rules.learn_rules(hard, _labels(spark, [])) == []
    assert quality_rules.learn_rules(hard, _labels(spark, [(0, None, 0), (None, 1, 0), (3, 1, 0), (3, 0, 0)])) == []
    assert quality_rules.quality_report(empty, _labels(spark, [(0, 1, 0)])).collect() == []
    kept = quality_rules.keep_good(hard, _labels(spark, []))
    assert kept.columns == hard.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in hard.collect() if not brute.quality_base(r.text)[5]}


def test_secrets(spark, folder, hard, empty):
    got = {r.doc_id: tuple(r)[1:5] for r in queries.op9_secret_ledger(spark, folder).collect()}
    assert got == {i: brute.secrets(t) for i, t, _ in _docs(folder)}
    rows = secret_ledger.secret_report(hard.union(hard)).collect()
    assert len(rows) == 2 * hard.count()
    assert all(tuple(r)[1:5] == brute.secrets(t) for r in rows for t in [dict((x.doc_id, x.text) for x in hard.collect())[r.doc_id]])
    assert secret_ledger.secret_report(empty).collect() == []


def test_secret_ledger_scans_only_unseen_pairs(spark, hard):
    first = hard.filter("doc_id < 30")
    _, ledger = secret_ledger.scan(first, rules=secret_ledger.BASE_RULES)
    assert ledger.count() == 3 * len({r.text or "" for r in first.collect()})
    paths, after = secret_ledger.scan(hard, ledger)
    new = after.exceptAll(ledger)
    texts = {r.text or "" for r in hard.collect()}
    assert after.count() == len(secret_ledger.RULES) * len(texts)  # each (blob, rule version) once
    assert new.count() == after.count() - ledger.count()
    assert secret_ledger.findings(paths, after).count() == hard.count()
    again = secret_ledger.scan(hard, after)[1]
    assert again.count() == after.count()


def test_mixing_targets_and_takes(spark, folder, hard, empty):
    rows = queries.op4_mixing(spark, folder).collect()
    docs = _docs(folder)
    size = {i: len(brute.WORD.findall(t or "")) for i, t, _ in docs}
    per = {}
    for i, _, s in docs:
        per[s] = per.get(s, 0) + size[i]
    want = brute.targets(per)
    source = {i: s for i, _, s in docs}
    taken = {}
    for r in rows:
        assert (r["size"], r.source_size) == (size[r.doc_id], per[source[r.doc_id]])
        assert r.target == pytest.approx(want[source[r.doc_id]], rel=1e-9)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    assert len(rows) == len(docs)
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    again = queries.op4_mixing(spark, folder).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)
    few = mixing.mix_report(hard.union(hard).withColumn("doc_id", F.expr("nullif(doc_id, 3)")))
    assert few.count() == 2 * hard.count() and few.filter("taken > 2 * size").count() == 0
    assert mixing.mix_report(empty).collect() == []


def test_mixed_documents_hold_the_taken_words(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = {}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(brute.WORD.findall(r.text))
        assert r.n_chars == len(r.text)
        whole = brute.WORD.findall(texts[r.doc_id])
        assert set(brute.WORD.findall(r.text)) <= set(whole)
    want = {r.doc_id: r.taken for r in mixing.mix_report(docs).collect() if r.taken}
    assert got == want


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 3, 7, 64, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5)).alias("x"))
        values = [r.x for r in got.collect()]
        assert sorted(values) == list(range(n))
        assert n < 64 or values != list(range(n))


def test_shard_counts_add_up(spark, folder):
    placed, sources = mixing.pack(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source"))
    drawn = mixing.slots(sources, shard_slots=16)
    counts = mixing.shard_counts(drawn)
    assert counts.select("shard").distinct().count() > 1
    totals = {r.sid: r.t for r in counts.groupBy("sid").agg(F.sum("tokens").alias("t")).collect()}
    for r in sources.collect():
        assert totals.get(r.sid, 0) == min(round(r.target), 2 * r.source_size)


def test_url_passwords_of_any_length(spark):
    token, user, scheme = "github_pat_" + "a1B2" * 21, "u" * 90, "a" + "b+c" * 10
    texts = [f"see https://{user}:{token}@host/x", f"{scheme}://me:{token}@host", f"https://host:8080/{token}@x and https://me:pw@h"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(x.start, x.end) for x in r.spans if x.kind == "url_password"]
           for r in secret_ledger.findings(*secret_ledger.scan(docs)).collect()}
    assert got == {0: [(4, texts[0].index("@") + 1)], 1: [(0, texts[1].index("@") + 1)], 2: []}


def test_secret_spans_of_dotted_and_crowded_texts(spark):
    """Long texts of runs and of very many findings are read in linear time; offsets stay exact."""
    import time

    crowded = " é".join(f"AKIA{k:016d}" for k in range(3000))
    rows = [(1, "a." * 100_000), (2, "eyJ-" * 50_000), (3, crowded), (4, "x -1.https://me:secret99@host y"), (5, "password " * 20_000)]
    before = time.time()
    got = {r.doc_id: r for r in secret_ledger.secret_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.time() - before < 60
    assert got[1].spans == got[2].spans == got[5].spans == ""
    assert got[3].spans == ",".join(f"access:{m.start()}:{m.end()}" for m in re.finditer("AKIA[A-Z0-9]{16,}", crowded))
    assert got[4].spans == "url_password:2:25"
