"""Statistics, time-series, ML-metric and streaming behaviour tests."""
import os

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from opsight.operators import forecasting as FC
from opsight.operators import ml as ML
from opsight.operators import stattests as S
from opsight.operators import timeseries as TS
from opsight.streaming.landing import run_landing_etl


def test_welch_and_pooled_match_textbook(spark):
    a = [1.0, 2.0, 3.0, 4.0, 5.0]
    b = [2.0, 4.0, 6.0, 8.0, 10.0, 12.0]
    df = spark.createDataFrame([(0, x) for x in a] + [(1, x) for x in b], "g int, x double")
    r = S.ttest_statistics(df, "x", "g", 0, 1, equal_var=True).first()
    m1, m2, v1, v2 = np.mean(a), np.mean(b), np.var(a, ddof=1), np.var(b, ddof=1)
    sp2 = (4 * v1 + 5 * v2) / 9
    assert r["t_statistic"] == pytest.approx((m1 - m2) / np.sqrt(sp2 * (1 / 5 + 1 / 6)))
    w = S.ttest_statistics(df, "x", "g", 0, 1, equal_var=False).first()
    assert w["t_statistic"] == pytest.approx((m1 - m2) / np.sqrt(v1 / 5 + v2 / 6))
    full = S.ttest(df, "x", "g", 0, 1).first()
    assert 0 <= full["p_value"] <= 1 and full["effect_size"] in ("small", "medium", "large")


def test_zero_variance_cohens_d_is_zero(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 1.0), (1, 1.0)], "g int, x double")
    assert S.ttest_statistics(df, "x", "g", 0, 1).first()["cohens_d"] == 0.0


def test_chi_square_yates_2x2(spark):
    # 2x2 table [[10, 20], [30, 40]] -> Yates chi2 = 0.4464 (textbook value)
    cells = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 40
    df = spark.createDataFrame(cells, "r string, c string")
    r = S.chi_square_statistics(df, "r", "c").first()
    assert r["degrees_of_freedom"] == 1
    assert r["chi2_statistic"] == pytest.approx(0.44642857, rel=1e-6)
    plain = S.chi_square_statistics(df, "r", "c", correction=False).first()
    assert plain["chi2_statistic"] == pytest.approx(0.79365079, rel=1e-6)


def test_chi_square_single_level(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y")], "r string, c string")
    r = S.chi_square(df, "r", "c").first()
    assert r["chi2_statistic"] == 0.0 and r["p_value"] == 1.0


def test_anova_matches_numpy(spark):
    groups = {"a": [1.0, 2.0, 3.0], "b": [2.0, 3.0, 4.0, 5.0], "c": [7.0, 8.0]}
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs] + [(None, 9.0)], "g string, x double")
    r = S.anova_statistics(df, "x", "g").first()
    allx = np.concatenate([np.array(v) for v in groups.values()])
    ssb = sum(len(v) * (np.mean(v) - allx.mean()) ** 2 for v in groups.values())
    ssw = sum(((np.array(v) - np.mean(v)) ** 2).sum() for v in groups.values())
    assert r["f_statistic"] == pytest.approx((ssb / 2) / (ssw / 6))


def test_decomposition_parts_sum(spark):
    rng = np.random.default_rng(1)
    vals = [10 + (i % 7) + rng.normal() for i in range(60)]
    df = spark.createDataFrame([(f"2024-01-{1 + i % 31:02d}", v) for i, v in enumerate(vals)], "d string, value double")
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "ts int, value double")
    out = TS.decompose(df, [], "ts", "value", period=7).filter(F.col("trend").isNotNull()).collect()
    assert len(out) == 54
    for r in out:
        assert r["trend"] + r["seasonal"] + r["resid"] == pytest.approx(r["value"])


@pytest.mark.parametrize("window,first_flaggable", [(30, 15), (31, 15)])
def test_centred_band_edges(spark, window, first_flaggable):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(100)], "ts int, value double")
    band = TS.anomaly_band(df, [], "ts", "value", window=window, sigma=0.1)
    got = sorted(r["ts"] for r in band.collect())
    assert got and min(got) >= first_flaggable
    after = window // 2 - 1 if window % 2 == 0 else window // 2
    assert max(got) <= 99 - after


def test_rolling_needs_full_window(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(31)], "ts int, value double")
    out = TS.rolling_stats(df, [], "ts", "value", 30).orderBy("ts").collect()
    assert out[28]["rolling_mean"] is None and out[29]["rolling_mean"] == pytest.approx(14.5)


def _series(spark, values, key="a"):
    rows = [(key, i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, day int, value double").withColumn(
        "ts", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day"))).drop("day")


def _plain_adf(x, longest):
    """ADF with a constant by least squares over NumPy designs: AIC on the common sample, refit on its own."""
    dx = np.diff(x)

    def fit(lag, first):
        y = dx[first:]
        cols = [x[first:-1], np.ones(len(y)), *[dx[first - k:len(dx) - k] for k in range(1, lag + 1)]]
        m = np.column_stack(cols)
        beta, *_ = np.linalg.lstsq(m, y, rcond=None)
        return y, m, beta, float(((y - m @ beta) ** 2).sum())

    aics = []
    for lag in range(longest + 1):
        y, _, _, ssr = fit(lag, longest)
        aics.append(len(y) * np.log(ssr / len(y)) + 2 * (lag + 2))
    lag = int(np.argmin(aics))
    y, m, beta, ssr = fit(lag, lag)
    cov = ssr / (len(y) - m.shape[1]) * np.linalg.inv(m.T @ m)
    return beta[0] / np.sqrt(cov[0, 0]), lag, len(y)


def test_adf_pvalue_and_power(spark):
    assert FC.adf_pvalue(-2.86) == pytest.approx(0.05, abs=0.002)
    rng = np.random.default_rng(7)
    walk = 1000 + np.cumsum(rng.normal(size=300))
    ar = np.zeros(300)
    for t in range(2, 300):
        ar[t] = 0.5 * ar[t - 1] - 0.3 * ar[t - 2] + rng.normal()
    both = _series(spark, walk, "walk").unionByName(_series(spark, ar, "ar")).unionByName(_series(spark, [1, 2, 3], "short"))
    got = {r["k"]: r for r in FC.adf(both, ["k"], chunk_rows=64).collect()}
    assert set(got) == {"walk", "ar", "short"} and got["short"]["adf_statistic"] is None
    for name, values in (("walk", walk), ("ar", ar)):
        stat, lag, nobs = _plain_adf(values, int(np.ceil(12 * (300 / 100) ** 0.25)))
        assert (got[name]["used_lag"], got[name]["nobs"]) == (lag, nobs)
        assert got[name]["adf_statistic"] == pytest.approx(stat, rel=1e-6)
    assert got["walk"]["p_value"] > 0.05 and got["ar"]["p_value"] < 0.01


def test_arima_forecasts(spark):
    rng = np.random.default_rng(3)
    y = np.zeros(900)
    e = rng.normal(size=900)
    for t in range(1, 900):
        y[t] = 0.7 * y[t - 1] + e[t] + 0.3 * e[t - 1]
    out = FC.arima(_series(spark, 5 + y), ["k"], order=(1, 0, 1), steps=60).orderBy("step").collect()
    assert len(out) == 60 and str(out[0]["ts"]) == "2026-06-19"
    assert out[-1]["forecast"] == pytest.approx(5 + y.mean(), abs=0.4)  # the process mean
    wide = [r["upper_95"] - r["lower_95"] for r in out]
    assert wide[0] == pytest.approx(2 * 1.96, rel=0.1) and all(a <= b + 1e-9 for a, b in zip(wide, wide[1:]))
    trend = FC.arima(_series(spark, np.arange(200) * 2.0 + np.sin(np.arange(200))), ["k"], order=(2, 1, 2), steps=10).collect()
    assert all(390 < r["forecast"] < 430 for r in trend)


def _css(y, p, q, params, d):
    """Conditional residuals of an ARIMA model, row by row."""
    w = np.diff(y, d)
    phi, theta, c = params[:p], params[p:p + q], params[p + q] if d == 0 else 0.0
    e = np.zeros(len(w))
    for t in range(p, len(w)):
        e[t] = w[t] - c - sum(phi[k] * w[t - 1 - k] for k in range(p)) - sum(theta[k] * e[t - 1 - k] for k in range(q) if t - 1 - k >= 0)
    return e[p:]


@pytest.mark.parametrize("chunk_rows", [64, 5000])
def test_arima_fit_over_chunks(spark, chunk_rows):
    """The fit is a minimum of the conditional sum of squares, whatever the chunks, and finds the true coefficients."""
    rng = np.random.default_rng(8)
    e = rng.normal(size=1500)
    w = np.zeros(1500)
    for t in range(2, 1500):
        w[t] = 0.5 * w[t - 1] - 0.3 * w[t - 2] + e[t] + 0.6 * e[t - 1]
    y = np.cumsum(w)
    both = _series(spark, y, "a").unionByName(_series(spark, 3 + w, "b")).unionByName(_series(spark, [1, 5, 2], "short"))
    fit = {r["k"]: r for r in FC.arima_fit(both, ["k"], order=(2, 1, 1), chunk_rows=chunk_rows).collect()}
    assert set(fit) == {"a", "b"}
    assert np.allclose(fit["a"]["params"], [0.5, -0.3, 0.6], atol=0.1)
    for name, series, d in (("a", y, 1), ("b", 3 + w, 1)):
        params = np.array(fit[name]["params"])
        own = _css(series, 2, 1, params, d)
        assert fit[name]["sse"] == pytest.approx((own ** 2).sum(), rel=1e-9) and fit[name]["nobs"] == len(own)
        assert fit[name]["residuals"][0] == pytest.approx(own[-1], abs=1e-7)
        for k in range(3):
            for step in (1e-3, -1e-3):
                moved = params + step * (np.arange(3) == k)
                if FC._outside(-moved[2:]):
                    assert (_css(series, 2, 1, moved, d) ** 2).sum() >= fit[name]["sse"] * (1 - 1e-9)
    out = FC.arima(both, ["k"], order=(2, 1, 1), steps=3, chunk_rows=chunk_rows).collect()
    assert len(out) == 7 and [r for r in out if r["k"] == "short"][0]["forecast"] is None


def test_arima_of_a_weekly_cycle_beats_the_last_value(spark):
    """A trend with a weekly cycle, on which the two regressions alone are not invertible."""
    rng = np.random.default_rng(4)
    t = np.arange(730)
    values = 50 + 0.02 * t + 6 * np.sin(2 * np.pi * t / 7) + rng.normal(0, 2, 730)
    df = _series(spark, values)
    split = TS.holdout_split(df, ["k"], horizon=30)
    train, test = split.filter(~F.col("is_test")).drop("is_test"), split.filter("is_test")
    fit = FC.arima_fit(train, ["k"], order=(2, 1, 2)).first()
    assert FC._outside(np.array(fit["params"][:2])) and FC._outside(-np.array(fit["params"][2:4]))
    ours = TS.forecast_errors(FC.arima(train, ["k"], order=(2, 1, 2), steps=30), test, ["k"]).first()
    last = TS.forecast_errors(FC.naive(train, ["k"], steps=30), test, ["k"]).first()
    assert ours["mae"] < last["mae"] and ours["rmse"] < last["rmse"]


def test_reflected_roots():
    inside = np.array([2.5, -1.0])  # 1 - 2.5 z + z^2: roots 2 and 1/2
    assert np.allclose(FC.reflected(inside), [1.0, -0.25])
    assert np.allclose(FC.reflected(np.array([0.5, 0.0])), [0.5, 0.0]) and not FC._outside(np.array([1.0]))


@pytest.mark.parametrize("range_rows", [30, 37, 1 << 16])
def test_windows_over_ranges_of_a_long_series(spark, range_rows):
    """Ranges with lent rows give what one window over the whole series gives."""
    rng = np.random.default_rng(6)
    rows = [(k, int(t), float(v)) for k in ("a", "b") for t, v in zip(rng.permutation(400 if k == "a" else 35), rng.normal(size=400))]
    df = spark.createDataFrame(rows, "k string, ts int, value double")
    w = Window.partitionBy("k").orderBy("ts")
    full = F.count("value").over(w.rowsBetween(-29, 0)) == 30
    plain = df.select("k", "ts", "value", F.when(full, F.avg("value").over(w.rowsBetween(-29, 0))).alias("m"))
    ours = TS.rolling_stats(df, ["k"], "ts", "value", 30, range_rows).select("k", "ts", "value", F.col("rolling_mean").alias("m"))
    key = lambda r: (r["k"], r["ts"])
    for x, y in zip(sorted(plain.collect(), key=key), sorted(ours.collect(), key=key), strict=True):
        assert key(x) == key(y) and x["m"] == pytest.approx(y["m"])
    parts = TS.decompose(df, ["k"], "ts", "value", 7, range_rows).collect()
    trend = {(r["k"], r["ts"]): r["t"] for r in df.select("k", "ts", F.when(F.count("value").over(w.rowsBetween(-3, 3)) == 7, F.avg("value").over(w.rowsBetween(-3, 3))).alias("t")).collect()}
    assert len(parts) == 435 and all(r["trend"] == pytest.approx(trend[(r["k"], r["ts"])]) for r in parts)
    band = {key(r) for r in TS.anomaly_band(df, ["k"], "ts", "value", 30, 1.0, range_rows).collect()}
    assert band == {key(r) for r in TS.anomaly_band(df, ["k"], "ts", "value", 30, 1.0).collect()} and band


def test_naive_forecast_and_errors(spark):
    df = _series(spark, [1, 2, 3, 4, 6, 9])
    split = TS.holdout_split(df, ["k"], horizon=2)
    ahead = FC.naive(split.filter(~F.col("is_test")), ["k"], steps=2)
    r = TS.forecast_errors(ahead, split.filter("is_test"), ["k"]).first()
    assert (r["n"], r["mae"]) == (2, 3.5) and r["rmse"] == pytest.approx(np.sqrt((4 + 25) / 2))


def test_kendall_matches_all_pairs(spark):
    rng = np.random.default_rng(11)
    rows = [(float(a), float(b)) for a, b in zip(rng.integers(0, 12, 80), rng.normal(size=80).round(1))]
    rows = [(a, b + a / 5) for a, b in rows] + [(None, 1.0), (2.0, None), (float("nan"), 1.0)]
    from opsight.operators import profile as P
    got = P.correlation_matrix(spark.createDataFrame(rows, "a double, b double"), method="kendall").first()["correlation"]
    whole = [(a, b) for a, b in rows if a is not None and b is not None and a == a]
    s = dx = dy = 0
    for i, (a, b) in enumerate(whole):
        for c, d in whole[:i]:
            s += np.sign(a - c) * np.sign(b - d)
            dx += a != c
            dy += b != d
    assert got == pytest.approx(s / np.sqrt(dx * dy))


def test_compare_models_runs_all_models(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(x), float(rng.normal()), int(x + rng.normal() > 0)) for i, x in enumerate(rng.normal(size=160))]
    df = spark.createDataFrame(rows, "customer_id long, f1 double, f2 double, churn int")
    cached = df.persist()  # a cached frame in the session must not matter
    cached.count()
    out, outcome = ML.compare_models(df, ["f1", "f2"], folds=2, trees=5, rounds=3)
    table = {r["model"]: r for r in out.collect()}
    cached.unpersist()
    assert set(table) == {"Logistic Regression", "Random Forest", "Gradient Boosted Trees"}
    assert sum(r["is_best"] for r in table.values()) == 1 and table[outcome["best"]]["is_best"]
    assert table["Logistic Regression"]["auc"] > 0.6 and table["Logistic Regression"]["cv_auc_mean"] > 0.6
    one = table["Random Forest"]
    assert one["train_rows"] + one["test_rows"] == 160 and abs(one["train_rate"] - one["test_rate"]) < 0.05
    parts = ML.evaluate_best(outcome, ["f1", "f2"])
    assert parts["confusion"].count() == 4 and parts["report"].count() == 4 and parts["importances"].first()["feature"] == "f1"


def test_stratified_split_is_exact(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(505)], "customer_id long, churn int")
    got = ML.stratified_split(df, "churn", "customer_id", 0.2, folds=5)
    counts = {(r["churn"], r["is_test"]): r["n"] for r in got.groupBy("churn", "is_test").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {(0, True): 91, (0, False): 363, (1, True): 10, (1, False): 41}
    per_fold = [r["n"] for r in got.filter("not is_test and churn = 1").groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sorted(per_fold) == [8, 8, 8, 8, 9]


def test_auc_symmetry_and_ties(spark):
    data = [(1, 0.9), (1, 0.4), (0, 0.4), (0, 0.1), (1, 0.7), (0, 0.3)]
    df = spark.createDataFrame(data, "label int, score double")
    auc = ML.roc_auc(df).first()["auc"]
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute)
    flipped = ML.roc_auc(df.withColumn("score", -F.col("score"))).first()["auc"]
    assert flipped == pytest.approx(1 - auc)
    curve = ML.roc_curve(df).orderBy(F.col("threshold").desc()).collect()
    assert curve[-1]["fpr"] == 1.0 and curve[-1]["tpr"] == 1.0


def test_confusion_matrix_zero_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "label int, prediction int")
    cells = {(r["actual"], r["predicted"]): r["count"] for r in ML.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_stream_restart_adds_only_new_files(spark, scratch):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    landing, zone, ckpt = f"{scratch}/landing", f"{scratch}/zone", f"{scratch}/ckpt"
    events.filter("event_id % 2 = 0").write.mode("overwrite").parquet(landing)
    with open(os.path.join(landing, "notes.txt"), "w") as fh:
        fh.write("not data")
    open(os.path.join(landing, "empty.parquet"), "w").close()
    schema = {"event_id": "int", "ts": "datetime", "value": "float"}
    extra = {"metrics_path": f"{scratch}/metrics", "reports_root": f"{scratch}/reports"}
    run_landing_etl(spark, landing, events.schema, zone, ckpt, schema, **extra)
    first = spark.read.parquet(zone).count()
    assert first == events.filter("event_id % 2 = 0").count()
    rejected = {os.path.basename(r["path"]): r["reason"] for r in spark.read.parquet(f"{zone}_rejected").collect()}
    assert rejected == {"notes.txt": "Unsupported file type", "empty.parquet": "Empty file"}
    metrics = {r["metric"]: r["value"] for r in spark.read.parquet(f"{scratch}/metrics").collect()}
    assert metrics["RowsProcessed"] == first and 0 < metrics["QualityScore"] <= 100
    assert spark.read.json(f"{scratch}/reports/*").first()["final_rows"] == first
    run_landing_etl(spark, landing, events.schema, zone, ckpt, schema, **extra)
    assert spark.read.parquet(zone).count() == first
    events.filter("event_id % 2 = 1").write.mode("append").parquet(landing)
    run_landing_etl(spark, landing, events.schema, zone, ckpt, schema, **extra)
    assert spark.read.parquet(zone).count() == events.count()


def test_stream_fails_on_a_broken_file_and_forgets_nothing(spark, scratch):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    landing, zone, ckpt = f"{scratch}/landing", f"{scratch}/zone", f"{scratch}/ckpt"
    events.write.mode("overwrite").parquet(landing)
    broken = os.path.join(landing, "broken.parquet")
    with open(broken, "wb") as fh:
        fh.write(b"PAR1 but nothing else")
    schema = {"event_id": "int", "ts": "datetime", "value": "float"}
    with pytest.raises(Exception):
        run_landing_etl(spark, landing, events.schema, zone, ckpt, schema, metrics_path=f"{scratch}/metrics")
    assert [r["metric"] for r in spark.read.parquet(f"{scratch}/metrics").collect()] == ["ProcessingErrors"]
    good = spark.read.parquet(*[os.path.join(landing, f) for f in os.listdir(landing) if f.startswith("part-")]).limit(0)
    good.coalesce(1).write.mode("overwrite").parquet(f"{scratch}/mended")
    mended = next(f for f in os.listdir(f"{scratch}/mended") if f.endswith(".parquet"))
    os.replace(f"{scratch}/mended/{mended}", broken)  # the file is repaired: the batch runs again
    run_landing_etl(spark, landing, events.schema, zone, ckpt, schema)
    assert spark.read.parquet(zone).count() == events.count()


def test_best_model_queries_share_one_comparison(spark, monkeypatch):
    """Comparison, report and importances are of one training of all three models, whichever is the best."""
    from opsight.plans import registry

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test data not present")
    compare, made = ML.compare_models, []

    def small(*args, **kwargs):
        if not made:
            made.append(compare(*args, **{**kwargs, "folds": 2}, trees=3, rounds=2))
            assert made[0][1]["best"] in made[0][1]["models"]
        calls.append(1)
        return made[0][0], {**made[0][1], "best": best}

    monkeypatch.setattr(ML, "compare_models", small)
    for best in ("Logistic Regression", "Random Forest", "Gradient Boosted Trees"):
        calls = []
        monkeypatch.setattr(registry, "_OUTCOMES", {})
        run = {n: registry.REGISTRY[n](spark, folder).collect() for n in ("ml_best_model_report", "ml_model_comparison", "ml_feature_importances", "ml_cv_fold_auc")}
        assert len(calls) == 1 and len(run["ml_model_comparison"]) == 3 and len(run["ml_cv_fold_auc"]) == 6
        assert run["ml_best_model_report"] == ML.classification_report(made[0][1]["scored"][best]).collect()
        rows = run["ml_feature_importances"]
        auc = made[0][1]["auc"]
        assert len(rows) == 15 and rows[0].model == max(("Random Forest", "Gradient Boosted Trees"), key=lambda n: auc[n])
        assert all(r.is_best == (r.model == best) for r in rows)
        model = made[0][1]["models"][rows[0].model].stages[-1]
        assert max(r.importance for r in rows) == max(model.featureImportances.toArray())


def test_training_tasks_do_not_grow_with_the_rows():
    assert [ML.training_partitions(n, 12) for n in (0, 15_000, 90_000, 900_000, 5_400_000)] == [1, 1, 4, 24, 24]
    assert ML.training_partitions(100_000_000, 12) == 100
