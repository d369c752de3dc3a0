"""Repeated passages, periodic runs and spelling variants against plain Python."""

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opsight.llm import periodic_runs, queries, spelling_variants, substring_dedup
from tests.llm import brute


def _docs(folder):
    return duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet' order by 1").fetchall()


def _variants(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_spelling_variants(spark, folder, hard, empty):
    assert _variants(queries.op13_spelling_variants(spark, folder)) == brute.spelling_variants(_docs(folder))
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    assert _variants(spelling_variants.spelling_variants(hard.union(hard))) == brute.spelling_variants(rows + rows)
    assert spelling_variants.spelling_variants(empty).collect() == []
    no_ids = hard.withColumn("doc_id", F.lit(None).cast("long"))
    assert _variants(spelling_variants.spelling_variants(no_ids)) == brute.spelling_variants([(None, t) for _, t in rows])


@pytest.mark.parametrize("frequent, entries", [(1, 1 << 17), (32, 1 << 17), (2, 60), (1 << 30, 1)])
def test_spelling_variants_of_dense_words(spark, monkeypatch, frequent, entries):
    """Few letters, so that grams repeat within a word and edits fall into runs of one letter; all sizes of dictionary."""
    monkeypatch.setattr(spelling_variants, "FREQUENT", frequent)
    monkeypatch.setattr(spelling_variants, "DICTIONARY", entries)
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abÀé"), int(n), p=[.6, .3, .05, .05])) for n in rng.integers(4, 9, 500)]
    words += ["".join(rng.choice(list("ab"), int(n))) for n in rng.integers(9, 16, 300)] + ["a" * n for n in range(4, 40)]
    words += [w[:k] + "b" + w[k:] for w in words[-60:] for k in (0, len(w) // 2, len(w))]
    rows = [(k, " ".join(np.repeat(words, rng.integers(1, 9, len(words))))) for k in range(2)]
    expected = brute.spelling_variants(rows)
    assert sum(v[3] for v in expected.values()) > 2000 and any(v[0] for v in expected.values())
    assert _variants(spelling_variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"))) == expected


def _stretches(texts):
    """Runs of each list of words, all taken together as in a task."""
    bounds = np.cumsum([0, *map(len, texts)])
    codes = {}
    words = np.array([hash_of(codes, w) for t in texts for w in t], np.uint64)
    runs = periodic_runs.periodic_stretches(words, bounds)
    return [sorted((int(a - lo), int(b - a), int(q)) for a, b, q in runs if lo <= a < hi) for lo, hi in zip(bounds, bounds[1:])]


def hash_of(codes, word):
    return codes.setdefault(word, len(codes) * 0x9E3779B97F4A7C15 % (1 << 64))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("aaab"), max_size=70), min_size=1, max_size=4),
       st.integers(1, 12), st.integers(1, 8))
def test_periodic_stretches(texts, period, times):
    texts = [*texts, texts[0][:period] * times + texts[-1], (texts[-1][:period] * times)[:-1] * 5]
    assert _stretches(texts) == [brute.periodic_runs(t) for t in texts]


def test_periodic_stretches_of_regular_texts():
    """Fibonacci and Thue-Morse words, powers of powers, one letter only, and long unary stretches within a period."""
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    morse = "a"
    while len(morse) < 512:
        morse += morse.translate(str.maketrans("ab", "ba"))
    texts = [fib[-1], morse, "a" * 333, ("a" * 10 + "b") * 9, (("ab" * 5 + "c") * 4 + "d") * 6, ("a" * 17 + "b" + "a" * 16 + "c") * 5,
             "x" + "abc" * 50 + "abd" * 50, ("aab" * 7 + "a" * 40) * 5]
    texts = [list(t) for t in texts]
    assert _stretches(texts) == [brute.periodic_runs(t) for t in texts]


def test_periodic_runs(spark, folder, hard, empty):
    got = sorted(tuple(r) for r in queries.op12_periodic_runs(spark, folder).collect())
    assert got == sorted(brute.run_row(i, t) for i, t in _docs(folder))
    assert sum(r[1] for r in got) > 10
    rows = [brute.run_row(r.doc_id, r.text if r.text is None or len(r.text) < 9999 else "w " * 500) for r in hard.collect()]
    small = hard.withColumn("text", F.expr("if(length(text) < 9999, text, if(text is null, null, repeat('w ', 500)))"))
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in periodic_runs.run_report(small.union(small)).collect()), key=key) == sorted(rows + rows, key=key)
    assert periodic_runs.run_report(empty).collect() == [] and periodic_runs.periodic_runs(empty).collect() == []
    long = [r for r in periodic_runs.periodic_runs(hard).collect() if r.doc_id == 33]
    assert [(r.start, r.length, r.period) for r in long] == [(0, 20000, 1)]
    none = periodic_runs.run_report(hard.withColumn("doc_id", F.lit(None).cast("long")))
    assert none.count() == hard.count() and none.filter("doc_id is not null").count() == 0


def _kept(df):
    rows = df.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows}


def _passages(rng, letters):
    """Texts that share passages: whole copies, parts at other places, copies with changed words, repetitions within one text."""
    pool = [[f"{c}{k}" for k in rng.integers(0, 300, 120)] for c in "pqr"]
    rows = []
    for k in range(60):
        words = [f"w{j}" for j in rng.integers(0, letters, int(rng.integers(0, 60)))]
        for _ in range(int(rng.integers(0, 4))):
            base = pool[int(rng.integers(3))]
            a = int(rng.integers(0, 90))
            part = base[a:a + int(rng.integers(5, 60))]
            if rng.random() < .3 and part:
                part[int(rng.integers(len(part)))] = "changed"
            at = int(rng.integers(0, len(words) + 1))
            words[at:at] = part
        rows.append((k * 7 % 61, " ".join(words)))
    return rows + [(100, "z " * 400), (101, "y " * 30 + "z " * 70), (102, " ".join("abcdefg" * 30)), (103, rows[5][1]), (104, None)]


@pytest.mark.parametrize("shard_words, key_words, letters", [(1 << 19, 1 << 16, 9999), (300, 1 << 16, 3), (1 << 19, 60, 9999), (200, 100, 2)])
def test_substring_dedup_of_shared_passages(spark, monkeypatch, shard_words, key_words, letters):
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(substring_dedup, "KEY_WORDS", key_words)
    rows = _passages(np.random.default_rng(letters), letters)
    got = _kept(substring_dedup.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute.substring_dedup(rows)


def test_fm_index_finds_all_places():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, 900).astype(np.uint64)
    bounds = np.array([0, 100, 100, 105, 500, 900])
    index = substring_dedup.FMIndex(words, bounds)
    starts = np.concatenate([np.arange(a, b - 4) for a, b in zip(bounds, bounds[1:])])
    places = {}
    for s in starts:
        places.setdefault(words[s:s + 5].tobytes(), []).append(int(s))
    live, lo, hi = index.repeated(starts, 5)
    assert set(starts[live]) == {s for p in places.values() if len(p) > 1 for s in p}
    shift = np.repeat(np.arange(5), np.diff(bounds))
    for k, a, b in zip(live, lo, hi):
        text_places = sorted(p + shift[p] for p in places[words[starts[k]:starts[k] + 5].tobytes()])
        assert sorted(index.suffixes[a:b]) == text_places


def test_substring_dedup(spark, folder, hard, empty):
    assert _kept(queries.op11_substring_dedup(spark, folder)) == brute.substring_dedup(_docs(folder))
    assert _kept(substring_dedup.dedup_report(hard)) == brute.substring_dedup([(r.doc_id, r.text) for r in hard.collect()])
    twice = substring_dedup.dedup_report(hard.union(hard)).distinct()
    assert _kept(twice) == _kept(substring_dedup.dedup_report(hard))
    assert substring_dedup.dedup_report(empty).collect() == []
    none = substring_dedup.dedup_report(hard.withColumn("doc_id", F.lit(None).cast("long")))
    assert none.count() == hard.count() and none.filter("n_removed > 0").count() == 0
    text = " ".join(f"a{k}" for k in range(25))
    rows = [(5, text + " b"), (5, "c " + text), (6, text), (None, text)]  # one document with two texts
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got in ({(5, 26, 0), (5, 26, 25), (6, 25, 25), (None, 25, 0)},)
