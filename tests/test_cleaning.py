"""Edge cases of the cleaning and quality operators."""
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opsight.operators import cleaning as C
from opsight.operators.quality import etl_quality_score, quality_score
from opsight.plans.cleaning_chain import CleaningChain
from opsight.sources.sinks import upsert


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_dedup_first_last_none(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (None, 0, "n1"), (None, 1, "n2")],
                               "k int, seq int, v string")
    assert rows(C.dedup_by_key(df, ["k"], "first", ["seq"]), "v") == [(1, 0, "a"), (2, 0, "c"), (None, 0, "n1")]
    assert rows(C.dedup_by_key(df, ["k"], "last", ["seq"]), "v") == [(1, 1, "b"), (2, 0, "c"), (None, 1, "n2")]
    assert rows(C.dedup_by_key(df, ["k"], False)) == [(2, 0, "c")]


def test_coerce_types_bad_values_become_null(spark):
    df = spark.createDataFrame([(" 12 ", "2024-01-02", "true"), ("x", "nope", "maybe")], "a string, d string, b string")
    out, coerced = C.coerce_types(df, {"a": "int", "d": "datetime", "b": "bool", "missing": "int"})
    assert coerced == ["a", "d", "b"]
    r = rows(out, "a")
    assert r[0][0] is None and r[0][1] is None and r[0][2] is None
    assert r[1][0] == 12 and str(r[1][1]) == "2024-01-02 00:00:00" and r[1][2] is True
    assert C.coercion_losses(df, {"a": "int", "d": "datetime"}) == {"a": 1, "d": 1}


def test_fill_smart_median_mode_and_drop(spark):
    df = spark.createDataFrame([(1.0, "b", None), (3.0, "a", None), (None, None, "z"), (5.0, "a", None)],
                               "x double, s string, mostly string")
    out, dropped, values = C.fill_smart(df)
    assert dropped == ["mostly"]
    assert values == {"x": 3.0, "s": "a"}
    assert rows(out, "x") == [(1.0, "b"), (3.0, "a"), (3.0, "a"), (5.0, "a")]


def test_mode_ties_pick_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    _, _, values = C.fill_smart(df, drop_threshold=0.9)
    assert values == {"s": "a"}


def test_outlier_remove_is_sequential(spark):
    data = [(float(i), float(i)) for i in range(20)] + [(1000.0, 5.0), (5.0, 1000.0)]
    df = spark.createDataFrame(data, "a double, b double")
    out, bounds = C.treat_outliers(df, ["a", "b"], "iqr", "remove")
    assert out.count() == 20
    assert set(bounds) == {"a", "b"}


def test_outlier_cap_and_flag_keep_nulls(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(None,), (500.0,)], "x double")
    capped, b = C.treat_outliers(df, ["x"], "iqr", "cap")
    lo, hi = b["x"]
    vals = [r[0] for r in capped.collect()]
    assert None in vals and max(v for v in vals if v is not None) == pytest.approx(hi)
    flagged, _ = C.treat_outliers(df, ["x"], "zscore", "flag")
    assert "x_outlier" in flagged.columns
    assert flagged.filter(F.col("x").isNull()).first()["x_outlier"] == 0


def test_quality_score_edges(spark):
    empty = spark.createDataFrame([], "a int, b string")
    r = quality_score(empty).first()
    assert r["overall_score"] is None and r["completeness"] is None
    df = spark.createDataFrame([(1, "1"), (1, "1"), (None, "x")], "a int, b string")
    r = quality_score(df, lexical=True).first()
    assert r["total_rows"] == 3 and r["duplicate_rows"] == 1 and r["total_nulls"] == 1
    assert r["consistency"] == 50.0
    assert 0 <= r["overall_score"] <= 100
    e = etl_quality_score(df).first()
    assert e["uniqueness"] == pytest.approx(66.7)


def test_upsert_null_keys_and_duplicates(spark):
    target = spark.createDataFrame([(1, "t1"), (2, "t2"), (None, "tn")], "k int, v string")
    staging = spark.createDataFrame([(2, "s2a"), (2, "s2b"), (3, "s3"), (None, "sn")], "k int, v string")
    got = sorted(rows(upsert(target, staging, ["k"]), "v"), key=lambda r: r[1])
    assert got == [(2, "s2a"), (2, "s2b"), (3, "s3"), (None, "sn"), (1, "t1"), (None, "tn")]


def test_chain_audit(spark):
    df = spark.createDataFrame([(1, 0, "  a  b "), (1, 1, "x"), (2, 0, None), (3, 0, "c")],
                               "id int, seq int, s string")
    clean, audit, summary = (CleaningChain(df).remove_duplicates(["id"], "first", ["seq"])
                             .handle_nulls("custom", {"s": "missing"}).standardize_formats().run())
    acts = {r["action"]: r["rows_affected"] for r in audit.collect()}
    assert acts["DEDUPLICATION"] == 1 and acts["NULL_HANDLING"] == 1 and acts["FORMAT_STANDARDIZATION"] == 1
    assert summary["initial_rows"] == 4 and summary["final_rows"] == 3
    assert sorted(r["s"] for r in clean.collect()) == ["a b", "c", "missing"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", " a", "b\t", None])), min_size=0, max_size=12))
def test_properties(spark, data):
    df = spark.createDataFrame(data, "k int, s string")
    once = C.dedup_by_key(df, ["k"], "first", ["s"])
    assert rows(C.dedup_by_key(once, ["k"], "first", ["s"])) == rows(once)
    std = C.standardize_strings(df)
    assert rows(C.standardize_strings(std)) == rows(std)
    if data:
        r = quality_score(df).first()
        assert 0 <= r["overall_score"] <= 100
