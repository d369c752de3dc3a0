"""Known-answer tests for the distribution functions and scalar helpers."""
import math

import pytest
from pyspark.sql import functions as F

from opsight.functions import distributions as D
from opsight.functions.scalar import clip, collapse_ws, month_offset, row_hash, strip_ws


@pytest.mark.parametrize("t,df,p", [(2.228, 10, 0.05), (1.96, 1e6, 0.05), (2.576, 1e6, 0.01)])
def test_t_critical_values(t, df, p):
    assert D.t_two_sided(t, df) == pytest.approx(p, abs=5e-4)


@pytest.mark.parametrize("x,k,p", [(3.841, 1, 0.05), (5.991, 2, 0.05), (15.507, 8, 0.05)])
def test_chi2_critical_values(x, k, p):
    assert D.chi2_sf(x, k) == pytest.approx(p, abs=5e-4)


def test_normal_and_f():
    assert 2 * D.normal_sf(1.96) == pytest.approx(0.05, abs=1e-4)
    assert D.f_sf(4.965, 1, 10) == pytest.approx(0.05, abs=5e-4)
    assert D.f_sf(0.0, 3, 10) == 1.0
    assert math.isnan(D.t_two_sided(float("nan"), 3))


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (5.0,), (50.0,)], "x double")
    got = [r[0] for r in df.select(clip("x", 0.0, 10.0)).collect()]
    assert got == [None, 0.0, 5.0, 10.0]


def test_whitespace_helpers(spark):
    df = spark.createDataFrame([("\t a \n  b\r ",), (None,), ("x",)], "s string")
    got = [tuple(r) for r in df.select(strip_ws("s"), collapse_ws(strip_ws("s"))).collect()]
    assert got == [("a \n  b", "a b"), (None, None), ("x", "x")]


def test_row_hash_nulls_and_width(spark):
    df = spark.createDataFrame([(1, None), (1, "a")], "a int, b string")
    h = [r[0] for r in df.select(row_hash(["a", "b"])).collect()]
    assert all(len(x) == 16 for x in h) and h[0] != h[1]


def test_month_offset(spark):
    df = spark.createDataFrame([("2024-03-15", "2023-12-01")], "a string, b string") \
        .select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    assert df.select(month_offset("a", "b")).first()[0] == 3
