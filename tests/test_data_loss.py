"""Values and files that must not be lost: means, casts, missing values, retries, settings."""
import os
import subprocess
import sys
from decimal import Decimal
from itertools import accumulate

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsight.functions import distributions as D
from opsight.functions.scalar import collapse_ws, exact_avg, exact_sum, strip_ws
from opsight.operators import cleaning as C
from opsight.operators import profile as P
from opsight.operators import ranks as R
from opsight.operators import stattests as S
from opsight.plans.cleaning_chain import CleaningChain
from opsight.sources.files import read_accepted, read_source
from opsight.sources import sinks
from opsight.sources.sinks import commit_upsert, current_version, write_zone

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("values", [[1e-12, 3e-12], [1e30, 2.0], [float("inf"), 2.0], [0.1, 0.2, 0.3], [2.5, None]])
def test_exact_mean_loses_no_value(spark, values):
    got = spark.createDataFrame([(v,) for v in values], "x double").agg(exact_avg("x"), exact_sum("x")).first()
    known = [v for v in values if v is not None]
    assert got[0] == pytest.approx(sum(known) / len(known)) and got[1] == pytest.approx(sum(known))


def test_whole_number_texts(spark):
    rows = [("12",), ("12.0",), (" 1e3 ",), ("9007199254740993",), ("12.7",), ("-12.7",), ("x",), ("1e40",), (None,)]
    df, _ = C.coerce_types(spark.createDataFrame(rows, "a string"), {"a": "int"})
    assert [r["a"] for r in df.collect()] == [12, 12, 1000, 9007199254740993, 12, -12, None, None, None]
    assert C.coercion_losses(spark.createDataFrame(rows, "a string"), {"a": "int"}) == {"a": 4}  # two fractions, no number, too large


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (3.0, None), (None, "b")], "x double, s string")
    filled, dropped, values = C.fill_smart(df, 0.6)
    assert values == {"x": 2.0, "s": "b"} and dropped == []
    assert sorted(r["x"] for r in filled.collect()) == [1.0, 2.0, 2.0, 3.0]
    assert C.columns_over_null_share(df, 0.4) == ["x"]
    assert [r["x"] for r in C.fill_custom(df, {"x": 9.0}).collect()].count(9.0) == 2
    assert C.count_outliers(df, {"x": (0.0, 2.0)}) == {"x": 1}
    row = P.profile(df).filter("column = 'x'").first()
    assert (row["non_null_count"], row["null_count"], row["mean"], row["median"]) == (2, 2, 2.0, 2.0)


def test_zero_and_negative_zero_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert {r["column"]: r["unique_count"] for r in P.distinct_counts(df, ["x"]).collect()} == {"x": 2}


def test_unicode_white_space(spark):
    text = "\u00a0\u2003a \u3000 b\u001c\u0085"
    got = spark.createDataFrame([(text,)], "s string").select(strip_ws("s"), collapse_ws(strip_ws("s"))).first()
    assert got[0] == text.strip() and got[1] == "a b"


def test_histogram_has_all_columns(spark):
    df = spark.range(5).select(*[(F.col("id") + k).alias(f"c{k}") for k in range(15)])
    assert P.histogram(df, bins=2).select("column").distinct().count() == 15


def test_zone_retry_replaces_its_run(spark, scratch):
    df = spark.range(10)
    for run in ("r1", "r2", "r1"):
        write_zone(df, f"{scratch}/zone", run)
    assert {r["run_id"]: r["count"] for r in spark.read.parquet(f"{scratch}/zone").groupBy("run_id").count().collect()} == {"r1": 10, "r2": 10}


def test_upsert_commit_switches_only_complete_versions(spark, scratch):
    root = f"{scratch}/table"
    assert current_version(spark, root) is None
    commit_upsert(spark, root, spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string"), ["k"])
    os.makedirs(f"{root}/data/unfinished/__bucket=1")  # a write that has not been committed
    staging = spark.createDataFrame([(2, "B"), (3, "C"), (None, "m")], "k int, v string")
    staging.createOrReplaceTempView("staging_rows")
    out = commit_upsert(spark, root, staging, ["k"], "staging_rows")
    key = lambda r: (r[0] is None, *r)
    assert sorted(map(tuple, out.collect()), key=key) == [(1, "a"), (2, "B"), (3, "C"), (None, "m"), (None, "n")]
    assert current_version(spark, root) == 1 and not spark.catalog.tableExists("staging_rows")
    assert sorted(r.v for r in sinks.read_version(spark, root, 0).collect()) == ["a", "b", "n"]


def test_upsert_of_two_writers(spark, scratch, monkeypatch):
    """A writer that is overtaken starts again from the other's version; untouched buckets keep their files."""
    root = f"{scratch}/table"
    rows = lambda pairs: spark.createDataFrame(pairs, "k long, v string")
    commit_upsert(spark, root, rows([(k, "old") for k in range(500)]), ["k"])
    before = sinks._manifest(spark, root, 0)["buckets"]
    claim, overtaken = sinks._claim, []

    def slow(*args):
        if not overtaken:
            overtaken.append(1)
            commit_upsert(spark, root, rows([(7, "second"), (1000, "second")]), ["k"])
        return claim(*args)

    monkeypatch.setattr(sinks, "_claim", slow)
    out = {r.k: r.v for r in commit_upsert(spark, root, rows([(3, "first"), (7, "first")]), ["k"]).collect()}
    assert current_version(spark, root) == 2 and len(out) == 501
    assert (out[3], out[7], out[1000], out[8]) == ("first", "first", "second", "old")
    after = sinks._manifest(spark, root, 2)["buckets"]
    assert sum(after[b] == f for b, f in before.items()) >= len(before) - 3 and len(before) == 64
    with pytest.raises(ValueError):
        commit_upsert(spark, root, rows([(1, "x")]), ["v"])


def test_bad_csv_lines_are_not_silent(spark, scratch):
    path = f"{scratch}/x.csv"
    with open(path, "w") as fh:
        fh.write("a,b\n1,x\ntwo,y\n")
    with pytest.raises(Exception):
        read_source(spark, path, "a int, b string").collect()
    rows = read_source(spark, path, "a int, b string", corrupt_column="bad").collect()
    assert [r["bad"] for r in rows] == [None, "two,y"]
    with pytest.raises(ValueError):
        read_source(spark, f"{scratch}/x.txt")


def test_gate_in_front_of_the_readers(spark, scratch):
    spark.createDataFrame([(1, "x")], "a int, b string").coalesce(1).write.parquet(f"{scratch}/in/p")
    os.makedirs(f"{scratch}/in/c")
    for name, text in (("y.csv", "a,b\n2,y\n"), ("z.xlsx", "?"), ("e.csv", "")):
        with open(f"{scratch}/in/c/{name}", "w") as fh:
            fh.write(text)
    rows, rejected = read_accepted(spark, f"{scratch}/in", "a int, b string")
    assert sorted((r["a"], r["b"]) for r in rows.collect()) == [(1, "x"), (2, "y")]
    assert {os.path.basename(r["path"]): r["reason"] for r in rejected.collect()} == {
        "z.xlsx": "Unsupported file type", "e.csv": "Empty file"}


def test_percentiles_and_modes(spark):
    rng = np.random.default_rng(4)
    groups = {"a": rng.normal(size=101), "b": rng.integers(0, 5, 64).astype(float), None: np.array([7.0])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None), ("c", None)]
    df = spark.createDataFrame(rows, "g string, value double")
    got = {r["g"]: r["q"] for r in R.exact_percentiles(df, ["g"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    assert set(got) == {"a", "b", None}
    for g, vs in groups.items():
        assert got[g] == pytest.approx(np.quantile(vs, [0, 0.25, 0.5, 0.9, 1]).tolist())
    modes = spark.createDataFrame([("b", 2, True), ("a", 10, None), ("b", 10, True), ("a", 2, False), (None, 9, None)], "s string, i int, t boolean")
    assert R.column_modes(modes, ["s", "i", "t"]) == {"s": "a", "i": 2, "t": True}
    assert R.column_percentiles(modes.limit(0), ["i"], [0.5]) == {}


def test_tail_probabilities_keep_their_digits():
    assert D.t_two_sided(2.5, 1e12) == pytest.approx(2 * D.normal_sf(2.5), rel=1e-9)
    assert D.t_two_sided(8.0, 1e12) == pytest.approx(2 * D.normal_sf(8.0), rel=1e-7)
    assert D.f_sf(4.0, 4.0, 1e12) == pytest.approx(D.chi2_sf(16.0, 4), rel=1e-6)
    assert D.betainc(2, 3, 0.4) == pytest.approx(0.5248, rel=1e-12)
    assert D.gammaincc(1.0, 3.0) == pytest.approx(np.exp(-3.0), rel=1e-12)
    assert D.betainc(30, 4, 0.85) == pytest.approx(1 - D.betainc(4, 30, 0.15), rel=1e-12)


def test_anova_means_and_paired_fields(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 6.0), (None, 9.0)], "g string, x double")
    r = S.anova(df, "x", "g").first()
    assert r["group_means"] == {"a": 2.0, "b": 5.5} and r["alpha"] == 0.05
    pairs = spark.createDataFrame([(1.0, 2.0), (2.0, 2.5), (3.0, 5.0), (4.0, None)], "a double, b double")
    p = S.paired_ttest(pairs, "a", "b").first()
    assert p["n_pairs"] == 3 and p["alpha"] == 0.05 and p["normality_ok"] in (True, False) and p["equal_variance"] in (True, False)


def test_chain_audit_counts(spark):
    rows = [(1, "1", " a "), (1, "1", "b"), (2, "x", None), (3, None, "c"), (4, "900", "c")]
    chain = (CleaningChain(spark.createDataFrame(rows, "id int, n string, s string"))
             .validate_schema({"n": "int", "gone": "str"}).remove_duplicates(["id"], "first", ["s"])
             .handle_nulls("smart", drop_threshold=0.9).treat_outliers(["n"]).standardize_formats())
    clean, audit, summary = chain.run()
    got = {r["action"]: (r["rows_affected"], r["details"]) for r in audit.collect()}
    assert got["SCHEMA_ERROR"][1] == {"missing": "gone"}
    assert got["SCHEMA_VALIDATION"] == (1, {"columns": "2", "coerced": "n"})
    assert got["DEDUPLICATION"][0] == 1 and got["NULL_HANDLING"][0] == 3 and got["FORMAT_STANDARDIZATION"][0] == 1
    assert (summary["initial_rows"], summary["final_rows"], clean.count()) == (5, 4, 4)
    chain.close()


def test_launcher_settings_win():
    code = ("import sys; sys.path.insert(0, %r); from opsight.session import build_session; s = build_session();"
            "print('GOT', s.conf.get('spark.sql.shuffle.partitions'), s.sparkContext.master, s.conf.get('spark.sql.adaptive.enabled'))" % ROOT)
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=2000 --conf spark.driver.memory=1g "
                                               "--conf spark.ui.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120).stdout
    assert "GOT 2000 local[2] true" in out


def test_value_summary(spark):
    """One summary gives distinct counts, percentiles, modes and outliers of all columns, also beyond double precision."""
    big = 9007199254740992
    rows = [(k % 7 + 0.5, big + k % 3, None if k % 2 else k) for k in range(50)] + [(float("nan"), None, 1000), (1e9, big, None)]
    df = spark.createDataFrame(rows, "a double, b long, c int")
    summary = R.value_summary(df, ["a", "b", "c"])
    distinct = {r["column"]: r["u"] for r in summary.groupBy("column").agg(F.sum("forms").alias("u")).collect()}
    assert distinct == {"a": 8, "b": 3, "c": 26}
    q = {r["column"]: list(r["q"]) for r in R.summary_percentiles(summary, [0.25, 0.5]).collect()}
    for k, c in enumerate("abc"):
        values = [float(r[k]) for r in rows if r[k] is not None and r[k] == r[k]]
        assert q[c] == pytest.approx(list(np.percentile(values, [25, 50])))
    assert {r["column"]: r["mode"] for r in R.summary_modes(summary).collect()}["a"] == 0.5
    out = {r["column"]: r["n_outliers"] for r in P.outlier_summary(df, ["a", "b", "c"], summary=summary).collect()}
    assert out == {"a": 1, "b": 0, "c": 1}
    none = P.outlier_summary(df.filter("c < 0"), ["a"]).first()
    assert none["n_outliers"] == 0 and none["lower_bound"] is None


def test_running_totals_shuffle_rows_once(spark):
    """The task of a range sums it up; only one row for each range is shuffled afterwards, and decimals stay exact."""
    rng = np.random.default_rng(8)
    data = sorted((int(v), Decimal(int(w)) / 100) for v, w in zip(rng.permutation(3000), rng.integers(1, 10 ** 6, 3000)))
    df = spark.createDataFrame([(v, w, 1) for v, w in data], "v long, w decimal(12,2), n int")
    totals = R.running_totals(df, ["v"], ["w", "n"])
    assert totals._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(__p") <= 1
    got = {r["v"]: (r["cum_w"], r["cum_n"]) for r in totals.collect()}
    assert got == {v: (s, k + 1) for k, ((v, _), s) in enumerate(zip(data, accumulate(w for _, w in data)))}
    down = {r["v"]: r["cum_n"] for r in R.running_totals(df, ["v"], ["n"], descending=True).collect()}
    assert down == {v: 3000 - k for k, (v, _) in enumerate(data)}
    summary = R.value_summary(df, ["v", "n"])
    assert "hashpartitioning" not in summary._jdf.queryExecution().executedPlan().toString()
    assert summary.filter("column = 'v' and upto = value + 1 and total = 3000").count() == 3000
