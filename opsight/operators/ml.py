"""Churn features, model comparison and classification metrics.

Features and metrics are plain DataFrame expressions (checkable in SQL);
models are Spark ML's regression and the trees of :mod:`opsight.operators.trees`. Metrics take a
``(label, score, prediction)`` frame, so they work for any model.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsight.session import shared_path
from opsight.operators import trees as T
from opsight.operators.ranks import average_rank, exact_percentiles, match, running_totals, totals_within, unpivoted, written


ROWS_PER_PARTITION = 25_000
MOST_ROWS = 1_000_000  # of a partition, however few cores there are


# ---------------------------------------------------------------- K1-K3
def engineer_features(df: DataFrame, tenure: str = "tenure_months", charges: str = "monthly_charges",
                      total: str = "total_charges", tickets: str = "num_support_tickets") -> DataFrame:
    """Interaction and threshold features (K1). ``high_value_customer`` compares
    with the exact 75th percentile of ``charges`` (one-row frame joined back)."""
    q = exact_percentiles(unpivoted(df, [charges]), [], [0.75]).select(F.col("q")[0].alias("__q75"))
    t1 = F.greatest(F.col(tenure), F.lit(1)).cast("double")
    return df.crossJoin(F.broadcast(q)).select(
        *df.columns,
        (F.col(total) / t1).alias("charge_per_month_tenure"),
        (F.col(tickets) / t1).alias("tickets_per_tenure"),
        (F.col(charges) > F.col("__q75")).cast("int").alias("high_value_customer"),
        (F.col(tenure) <= 6).cast("int").alias("new_customer"),
        (F.col(tenure) >= 48).cast("int").alias("long_tenure"),
    )


def one_hot(df: DataFrame, columns: Sequence[str], drop_first: bool = True, most: int = 1000) -> DataFrame:
    """0/1 indicator columns ``{col}_{level}`` per category level, the
    alphabetically first level dropped (K2). NULL gives all zeros.

    Levels are the distinct values, read in one grouped pass. A column with more than ``most`` levels is
    no category and raises, before its levels reach the driver.
    """
    cols = list(columns)
    if not cols:
        return df
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])).alias("p"))
    found: dict[str, list[str]] = {c: [] for c in cols}
    for r in pairs.select("p.*").filter("v is not null").distinct().limit(most * len(cols) + 1).collect():
        found[r["c"]].append(r["v"])
    out = []
    for c in cols:
        levels = sorted(found[c])
        if len(levels) > most or sum(map(len, found.values())) > most * len(cols):
            raise ValueError(f"more than {most} levels in {cols}")
        keep = levels[1:] if drop_first else levels
        out += [F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
                for v in keep]
    return df.select(*[x for x in df.columns if x not in cols], *out)


def stratified_order(df: DataFrame, label: str, id_col: str, seed: int = 42) -> DataFrame:
    """Add ``__place`` (1-based rank of a seeded md5 of the id within the label) and ``__size`` (rows of the label).

    Ranks come from range partitions with running totals, so no label's rows meet in one task. Rows with
    one id share their place.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    keyed = df.withColumn("__key", key)
    ranked = running_totals(keyed.select(F.col(label).alias("__label"), "__key", F.lit(1).alias("__one")),
                            ["__label", "__key"], ["__one"])
    heads = ranked.groupBy("__label").agg(F.min(F.col("cum___one") - F.col("__one")).alias("__start"), F.sum("__one").alias("__size"))
    places = match(ranked, heads, ["__label"]).select(
        F.col("__label").alias(label), "__key", (F.col("cum___one") - F.col("__one") + 1 - F.col("__start")).alias("__place"), "__size")
    return match(keyed, places, [label, "__key"]).drop("__key")


def stratified_split(df: DataFrame, label: str, id_col: str, test_fraction: float = 0.2,
                     seed: int = 42, folds: int | None = None) -> DataFrame:
    """Add ``is_test``: of each class the rows of the lowest seeded hash, ``test_fraction`` of the class
    rounded to whole rows (K3). With ``folds`` the training rows get ``fold`` in turn, so folds are
    stratified too (K11)."""
    ordered = stratified_order(df, label, id_col, seed)
    n_test = F.round(F.col("__size") * F.lit(test_fraction)).cast("long")
    out = ordered.withColumn("is_test", F.col("__place") <= n_test)
    if folds:
        out = out.withColumn("fold", F.when(~F.col("is_test"), ((F.col("__place") - n_test - 1) % folds).cast("int")))
    return out.drop("__place", "__size")


# ---------------------------------------------------------------- K8-K13
def accuracy_f1(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and F1 of the positive class (K8)."""
    y, p = F.col(label), F.col(prediction)
    m = scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == p).alias("correct"),
                   F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                   F.count_if((y == 1) & (p == 0)).alias("fn"))
    return m.select(
        (F.col("correct") / F.col("n")).alias("accuracy"),
        F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0,
               2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(F.lit(0.0)).alias("f1"))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC by the rank-sum (Mann-Whitney) formula with average ranks for ties (K9)."""
    ranked = average_rank(scored.select(F.col(label).alias("y"), F.col(score).cast("double").alias("s")), "s", "r")
    m = ranked.agg(F.sum(F.when(F.col("y") == 1, F.col("r"))).alias("rsum"),
                   F.count_if(F.col("y") == 1).cast("double").alias("npos"),
                   F.count_if(F.col("y") == 0).cast("double").alias("nneg"))
    return m.select(((F.col("rsum") - F.col("npos") * (F.col("npos") + 1) / 2)
                     / (F.col("npos") * F.col("nneg"))).alias("auc"))


def group_auc(scored: DataFrame, by: Sequence[str], label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC of each group, in one job for all (K9, K11): the share of pairs of a positive and a negative row
    that the score orders right, ties half. NULL for groups of one class."""
    by = list(by)
    s = scored.select(*by, F.col(score).cast("double").alias("s"), (F.col(label) == 1).cast("long").alias("pos"), (F.col(label) == 0).cast("long").alias("neg"))
    at = s.groupBy(*by, "s").agg(F.sum("pos").alias("pos"))
    below = match(totals_within(s, by, ["s"], "neg"), at, [*by, "s"])
    right = below.groupBy(*by).agg(F.sum(F.col("pos") * (2 * F.col("__upto") - F.col("__own"))).alias("twice"),
                                   F.sum("pos").alias("p"), F.max("__all").alias("n"))
    return right.select(*by, F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("twice") / (2.0 * F.col("p") * F.col("n"))).alias("auc"))


def cv_summary(fold_aucs: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and population standard deviation of the folds' AUC, and the folds that have one."""
    return fold_aucs.groupBy(*by).agg(F.count("auc").alias("folds"), F.avg("auc").alias("cv_auc_mean"), F.stddev_pop("auc").alias("cv_auc_std"))


def best_by_auc(scored: DataFrame, by: str = "model") -> DataFrame:
    """AUC of each model's scores, and which is the best (ties: the first by name)."""
    aucs = group_auc(scored, [by])
    first = aucs.filter("auc is not null").agg(F.min(F.struct((-F.col("auc")).alias("a"), by))[by].alias("__best"))  # one row
    return aucs.crossJoin(F.broadcast(first)).select(by, "auc", (F.col(by) == F.col("__best")).alias("is_best"))


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ROC points per distinct score threshold: fpr, tpr for 'score ≥ threshold' (K10)."""
    s = scored.select(F.col(score).cast("double").alias("threshold"),
                      (F.col(label) == 1).cast("long").alias("pos"), (F.col(label) == 0).cast("long").alias("neg"))
    tot = s.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N_"))
    cum = running_totals(s, ["threshold"], ["pos", "neg"], descending=True)
    return cum.crossJoin(F.broadcast(tot)).select(
        "threshold", (F.col("cum_neg") / F.col("N_")).alias("fpr"), (F.col("cum_pos") / F.col("P")).alias("tpr"))


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """All four cells of the binary confusion matrix, zero-filled."""
    y, p = F.col(label), F.col(prediction)
    m = scored.agg(*[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    cells = F.explode(F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"),
                                         F.col(f"c{a}{b}").cast("long").alias("count"))
                                for a in (0, 1) for b in (0, 1)]))
    return m.select(cells.alias("c")).select("c.*")


def classification_report(scored: DataFrame, label: str = "label", prediction: str = "prediction",
                          names: Sequence[str] = ("Retained", "Churned")) -> DataFrame:
    """Precision, recall, F1 and support per class plus macro and weighted averages."""
    cm = confusion_matrix(scored, label, prediction)
    agg = cm.agg(*[F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == b), F.col("count")))
                   .alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    rows = []
    for k, name in enumerate(names):
        tp = F.col(f"c{k}{k}")
        pred = F.col(f"c0{k}") + F.col(f"c1{k}")
        sup = F.col(f"c{k}0") + F.col(f"c{k}1")
        prec = F.when(pred > 0, tp / pred).otherwise(F.lit(0.0))
        rec = F.when(sup > 0, tp / sup).otherwise(F.lit(0.0))
        f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
        rows.append((name, prec, rec, f1, sup))
    total = rows[0][4] + rows[1][4]
    macro = ("macro avg", *[(rows[0][i] + rows[1][i]) / 2 for i in (1, 2, 3)], total)
    weighted = ("weighted avg", *[(rows[0][i] * rows[0][4] + rows[1][i] * rows[1][4]) / total for i in (1, 2, 3)],
                total)
    structs = [F.struct(F.lit(n).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        s.cast("long").alias("support"))
               for n, p, r, f, s in [*rows, macro, weighted]]
    return agg.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


# ---------------------------------------------------------------- K4-K7, K11, K14, K15
MODELS = ("Logistic Regression", "Random Forest", "Gradient Boosted Trees")


def _linear(n_train: int) -> LogisticRegression:
    # C = 1 in the original's objective (sum of losses + ||w||²/2) is regParam = 1 / n_train in Spark's mean-loss objective.
    return LogisticRegression(maxIter=1000, regParam=1.0 / max(n_train, 1), elasticNetParam=0.0, standardization=False, tol=1e-10,
                              featuresCol="scaled")


def assembled(df: DataFrame, features: Sequence[str], label: str, extra: Sequence[str] = ()) -> DataFrame:
    """``(label, features, extra...)`` with the feature vector, as a written table: every fit reads it
    without recomputing the features."""
    vector = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    rows = vector.transform(df).select(F.col(label).cast("double").alias("label"), "features", *extra)
    path = shared_path(df.sparkSession, "features")
    rows.write.mode("overwrite").parquet(path)
    table = df.sparkSession.read.schema(rows.schema).parquet(path)
    return table.repartition(training_partitions(table.count(), df.sparkSession.sparkContext.defaultParallelism))


def training_partitions(rows: int, cores: int) -> int:
    """Partitions of a table that thousands of short training jobs read: few for small tables, two for each core for
    others. Each task of each job sends its result to the driver, so their number must not grow with the rows; only
    partitions beyond ``MOST_ROWS`` rows are split."""
    return max(1, min(-(-rows // ROWS_PER_PARTITION), 2 * cores), -(-rows // MOST_ROWS))


def scaled(df: DataFrame, features: Sequence[str], id_col: str = "customer_id") -> DataFrame:
    """``(id, features...)`` with mean 0 and sample standard deviation 1 (K4); a constant feature becomes 0."""
    vector = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep").transform(df).select(id_col, "features")
    model = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(vector)
    values = model.transform(vector).select(id_col, vector_to_array("scaled").alias("v"))
    return values.select(id_col, *[F.col("v")[k].alias(f) for k, f in enumerate(features)])


def fit_model(est, train: DataFrame):
    """The scaler (K4) and the estimator, fitted on ``train(label, features)``.

    The fitted model is saved and loaded again: a fresh model keeps a training summary, which holds the
    session, and a plan that scores with it cannot be sent to the executors once any frame is cached.
    """
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    path = shared_path(train.sparkSession, "model")
    Pipeline(stages=[scaler, est]).fit(train).write().overwrite().save(path)
    return PipelineModel.load(path)


def fit_trees(train: DataFrame, names: Sequence[str], held_out: Sequence[int | None], trees: int, rounds: int, seed: int) -> dict[str, list]:
    """The models of the tree learners among ``names``, one for each held-out fold (None: none), fitted on
    ``train(label, features, fold)``; trees take the raw features."""
    if not {*MODELS[1:]} & {*names}:
        return {}
    # blocks are small: a partition for each core
    rows, cores = train.count(), train.sparkSession.sparkContext.defaultParallelism
    data, out = T.blocks(train, min(cores, training_partitions(rows, cores)) if rows <= cores * MOST_ROWS else training_partitions(rows, cores)), {}
    try:
        if MODELS[1] in names:
            out[MODELS[1]] = T.models(T.fit_forests(data, held_out, trees, 10, seed), data.cuts, False)
        if MODELS[2] in names:
            out[MODELS[2]] = T.models(T.fit_boosted(data, held_out, rounds), data.cuts, True)
    finally:
        data.blocks.unpersist()
    return out


def score_model(model, rows: DataFrame) -> DataFrame:
    """``(label, score, prediction)`` of the rows."""
    return model.transform(rows).select(F.col("label").cast("int").alias("label"), vector_to_array("probability")[1].alias("score"),
                                        F.col("prediction").cast("int").alias("prediction"))


def compare_models(df: DataFrame, features: Sequence[str], label: str = "churn", id_col: str = "customer_id",
                   folds: int = 5, seed: int = 42, models: Sequence[str] | None = None,
                   trees: int = 100, rounds: int = 100, parallelism: int = 6,
                   cross_validate: bool = True) -> tuple[DataFrame, dict]:
    """Train each model on a stratified 80 % split, score the 20 % test side and report accuracy, F1, AUC
    and k-fold CV AUC (mean, population std), with split sizes and label rates (K15).

    The scaler is fitted inside each fit (train part or CV fold), not on the whole frame before folding.
    Up to ``parallelism`` linear fits run at a time on one written feature table, and the trees of all fits of a model
    grow together (:mod:`opsight.operators.trees`); their bins are of the train side's features, without labels. Without ``cross_validate`` the CV figures
    are NULL; models, scores and the best one are the same, as the CV AUC takes no part in them. Returns the comparison frame and a dict of
    the fitted models, the name of the best (by AUC) and the scored test rows of each.
    """
    feats = list(features)
    spark = df.sparkSession
    table = assembled(stratified_split(df, label, id_col, 0.2, seed, folds), feats, label, ["is_test", "fold"]).persist()
    try:
        counts = {r["is_test"]: r for r in table.groupBy("is_test").agg(
            F.count(F.lit(1)).alias("n"), F.avg("label").alias("rate")).collect()}
        sizes = [counts[k]["n"] if k in counts else 0 for k in (False, True)]
        rates = [float(counts[k]["rate"]) if k in counts else None for k in (False, True)]
        train, test = table.filter("not is_test").drop("is_test"), table.filter("is_test").drop("is_test", "fold")
        rows, scored = [], {}
        chosen = [n for n in MODELS if models is None or n in models]
        held_out = [None, *range(folds if cross_validate else 0)]

        def fit_linear(fold):
            part = train if fold is None else train.filter(F.col("fold") != fold)
            return fit_model(_linear(sizes[0] if fold is None else part.count()), part)

        def fold_scores(name, model, fold):
            return written(score_model(model, train.filter(F.col("fold") == fold)), "cv").select(
                F.lit(name).alias("model"), F.lit(fold).alias("fold"), "label", "score")

        # small fits and scores are independent jobs: they share the cluster instead of queueing
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            linear = [pool.submit(fit_linear, fold) for fold in held_out] if MODELS[0] in chosen else []
            by_fit = fit_trees(train, chosen, held_out, trees, rounds, seed)
            by_fit |= {MODELS[0]: [f.result() for f in linear]} if linear else {}
            parts = [pool.submit(fold_scores, n, by_fit[n][i], fold) for n in chosen for i, fold in enumerate(held_out) if fold is not None]
            fitted = {n: by_fit[n][0] for n in chosen}
            folded = [f.result() for f in parts]
        cv, fold_aucs = {}, None
        if folded:
            fold_aucs = written(group_auc(reduce(DataFrame.unionByName, folded), ["model", "fold"]), "fold_auc")
            cv = {r["model"]: r for r in cv_summary(fold_aucs).collect()}  # a row for each model
        for name, model in fitted.items():
            path = shared_path(spark, "scored")
            score_model(model, test).write.mode("overwrite").parquet(path)
            scored[name] = spark.read.parquet(path)
            af, auc = accuracy_f1(scored[name]).first(), roc_auc(scored[name]).first()["auc"]
            mean, std = (cv[name]["cv_auc_mean"], cv[name]["cv_auc_std"]) if name in cv else (None, None)
            rows.append((name, af["accuracy"], af["f1"], auc, mean, std))
    finally:
        table.unpersist()
    best = max(rows, key=lambda r: -1.0 if r[3] is None else r[3])[0] if rows else None
    out = spark.createDataFrame(
        [(*r, *sizes, *rates, r[0] == best) for r in rows],
        "model string, accuracy double, f1 double, auc double, cv_auc_mean double, cv_auc_std double, "
        "train_rows long, test_rows long, train_rate double, test_rate double, is_best boolean")
    return out, {"models": fitted, "best": best, "scored": scored, "auc": {r[0]: r[3] for r in rows}, "folds": fold_aucs}


def evaluate_best(outcome: dict, features: Sequence[str]) -> dict[str, DataFrame]:
    """ROC points, confusion matrix, report and importances of the best fitted model."""
    scored = outcome["scored"][outcome["best"]]
    rows = feature_importances(outcome["models"][outcome["best"]], features)
    return {"roc": roc_curve(scored), "confusion": confusion_matrix(scored), "report": classification_report(scored),
            "importances": scored.sparkSession.createDataFrame(rows, "feature string, importance double")}


def feature_importances(model, features: Sequence[str], top: int = 15) -> list[tuple[str, float]]:
    """Top ``top`` importances of a fitted model (K14): of trees their own, of a linear model the absolute
    coefficients of the scaled features."""
    last = model.stages[-1]
    imp = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    return sorted(zip(features, map(float, imp)), key=lambda t: -t[1])[:top]
