"""Trees on binned features against Spark ML's, and what held-out folds may not change."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from opsight.operators import ml as ML
from opsight.operators import trees as T

NAMES = ["a", "b", "c", "d"]


def rows(n=1500, seed=3):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.integers(0, 30, n), rng.integers(0, 2, n), rng.integers(0, 25, n), rng.integers(0, 7, n)].astype(float)
    y = (x[:, 0] / 10 + x[:, 1] + np.sin(x[:, 2]) + rng.normal(size=n) > 2).astype(int)
    return [(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]


def frame(spark, found):
    return spark.createDataFrame(found, "customer_id long, a double, b double, c double, d double, churn int")


def table(spark, found):
    made = ML.assembled(frame(spark, found).withColumn("fold", (F.col("customer_id") % 3).cast("int")), NAMES, "churn", ["fold", "customer_id"])
    return made.repartition(3, "customer_id").sortWithinPartitions("customer_id").persist()  # whatever the labels are


def scores(model, part):
    return np.array([r["score"] for r in ML.score_model(model, part.orderBy("customer_id")).collect()])


def test_boosted_trees_are_those_of_spark_ml(spark):
    part = table(spark, rows())
    data = T.blocks(part, 3)
    model = T.models(T.fit_boosted(data, [None], 4), data.cuts, True)[0]
    spark_ml = GBTClassifier(maxIter=4, seed=1).fit(part)
    assert np.allclose(scores(model, part), scores(spark_ml, part), atol=1e-9)
    assert np.allclose(model.stages[-1].featureImportances.toArray(), spark_ml.featureImportances.toArray(), atol=1e-9)
    both = ML.score_model(model, part).agg(F.count_if((F.col("score") > 0.5) != (F.col("prediction") == 1))).first()[0]
    assert both == 0


def test_forest_is_like_spark_mls(spark):
    part = table(spark, rows())
    data = T.blocks(part, 3)
    model = T.models(T.fit_forests(data, [None], 60), data.cuts, False)[0]
    spark_ml = RandomForestClassifier(numTrees=60, maxDepth=10, seed=1).fit(part)
    new = table(spark, rows(seed=4))
    ours, theirs = scores(model, new), scores(spark_ml, new)
    assert np.corrcoef(ours, theirs)[0, 1] > 0.97 and abs(ours.mean() - theirs.mean()) < 0.02
    assert abs(model.stages[-1].featureImportances.toArray() - spark_ml.featureImportances.toArray()).max() < 0.05
    label = np.array([r["label"] for r in new.orderBy("customer_id").collect()])
    assert ((ours > 0.5) == label).mean() > ((theirs > 0.5) == label).mean() - 0.03


def test_held_out_labels_do_not_matter(spark):
    """A fit without fold 1 is the same for any labels of it, and the same as one without its rows."""
    found = rows(900)
    turned = [(*r[:-1], 1 - r[-1]) if r[0] % 3 == 1 else r for r in found]
    out = []
    for part in (table(spark, found), table(spark, turned)):
        data = T.blocks(part, 3)
        out.append((T.fit_boosted(data, [None, 1], 3), T.fit_forests(data, [None, 1], 4)))
    for one, other in zip(*out):
        assert all(np.allclose(a, b) for a, b in zip(one[1], other[1]))
        assert not np.array_equal(one[0].value, other[0].value)


@pytest.mark.parametrize("kept", [1, 2])
def test_margins_added_up_anew_are_the_same(spark, monkeypatch, kept):
    data = T.blocks(table(spark, rows(600)), 2)
    whole = T.fit_boosted(data, [None, 2], 5)
    monkeypatch.setattr(T, "ROUNDS_KEPT", kept)
    for one, other in zip(whole, T.fit_boosted(data, [None, 2], 5)):
        assert all(np.allclose(a, b) for a, b in zip(one, other))


def test_cuts_see_every_row(spark):
    """A value of one row in 20,000 has its cut; many values are cut into even shares."""
    df = spark.range(20_000).select(F.array((F.col("id") == 777).cast("double"), F.col("id").cast("double"), F.lit(1.0)).alias("x"))
    rare, many, none = T.cut_points(df.repartition(3))
    assert rare.tolist() == [0.5] and none.tolist() == [] and len(many) == 31
    assert abs(np.diff([0, *many, 20_000]) - 625).max() < 60


def test_places_and_splits_by_brute_force():
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 32, (6, 500)).astype(np.uint8)
    feature, cut = rng.integers(0, 6, 255), np.where(rng.random(255) < 0.2, 255, rng.integers(0, 31, 255)).astype(np.uint8)
    at = np.zeros(500, int)
    for depth in range(8):
        assert T.places(feature, cut, bins, depth).tolist() == at.tolist()
        at = 2 * at + 1 + (bins[feature[at], np.arange(500)] > cut[at])
    block, weight = T.Block((0, 0), 0, bins, bins, rng.integers(0, 2, 500).astype(np.uint8)), T.bag(1, 2, (0, 0), 500)
    subset, at = np.array([[0, 3], [1, 5], [2, 4]]), T.places(feature, cut, bins, 6)
    nodes = np.unique(at)[:3]
    got = T.bagged_counts([T.bagged(block, weight)], (feature, cut), T._slots(nodes, 7), subset, 6)
    for i, node in enumerate(nodes):
        for j in range(2):
            for c in range(32):
                here = (at == node) & (bins[subset[i, j]] == c)
                assert got[i, j, c].tolist() == [weight[here].sum(), (weight * block.label)[here].sum()]
    counts = np.stack([rng.integers(0, 5, (3, 2, 8)).astype(float)] * 2, axis=-1)
    counts[..., 1] *= rng.random((3, 2, 8))
    counts[:, 1] = counts[:, 0][:, ::-1]  # the same rows by another feature
    for node, got in enumerate(zip(*T.best_splits(counts))):
        total, best = counts[node, 0].sum(axis=0), (0.0, 0, 0)
        for k in range(2):
            for c in range(7):
                left, right = counts[node, k, :c + 1].sum(axis=0), counts[node, k, c + 1:].sum(axis=0)
                if left[0] and right[0]:
                    gain = left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - total[1] ** 2 / total[0]
                    best = max(best, (gain, k, c))
        assert got[2] == pytest.approx(best[0])


def test_more_folds_are_no_more_training_jobs(spark):
    """Trees of all folds grow in the same jobs; a fold adds only its scoring."""
    df, jobs = frame(spark, rows(300)), []
    for folds in (2, 5):
        before = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
        ML.compare_models(df, NAMES, folds=folds, rounds=4, models=["Gradient Boosted Trees"])
        jobs.append(spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() - before)
    assert jobs[1] - jobs[0] < 10
