from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from accountrisk.operators import calibration as C
from accountrisk.operators import importance as I
from accountrisk.operators import metrics as M
from accountrisk.operators import training as T
from accountrisk.operators.quantiles import exact_quantiles
from accountrisk.operators.splits import (
    class_share_rank,
    stratified_sample,
    train_test_split,
    with_folds,
)
from accountrisk.operators import workflow as W
from accountrisk.operators.ensembles import nested_scores
from accountrisk.session import written
from accountrisk.sources import registry as G
from accountrisk.sources.mart import table

NUMERIC = ["monthly_recurring_revenue", "nps_score"]
# Small models, so that the tests look at how models are used, not at how well they fit.
FOREST = {"numTrees": 10, "maxDepth": 4}
GBT = {"maxIter": 4, "maxDepth": 3}


@pytest.fixture(scope="module")
def learnable(spark, mart):
    """The mart with a label that follows two of its columns."""
    (middle,) = exact_quantiles(mart, ["monthly_recurring_revenue"], [0.5]).values()
    risk = F.col("monthly_recurring_revenue") / middle[0] + F.when(
        F.col("plan_tier") == "Starter", 1.0
    ).otherwise(0.0)
    noise = F.pmod(F.xxhash64("customer_id"), F.lit(100)) / 100.0
    return written(mart.withColumn("churn", (risk + noise > 1.8).cast("int")), "learnable")


def pipeline(kind="random_forest", **params):
    return T.make_pipeline(kind, NUMERIC, ["plan_tier"], **(params or FOREST))


def test_split_and_folds_are_stratified(mart):
    train, test = train_test_split(mart, "churn", "customer_id")
    assert train.count() + test.count() == mart.count()
    for part, share in ((test, 0.2), (train, 0.8)):
        counts = {r["churn"]: r["count"] for r in part.groupBy("churn").count().collect()}
        for label, n in mart.groupBy("churn").count().collect():
            assert abs(counts[label] - share * n) <= 1
    folds = with_folds(mart, "churn", "customer_id", 5)
    sizes = folds.groupBy("churn", "fold").count().groupBy("churn").agg(
        F.max("count") - F.min("count"), F.count("*")
    )
    assert all(gap <= 2 and n == 5 for _, gap, n in sizes.collect())


def test_rows_without_a_usual_label_stay(spark):
    labels = [None, 0, 1, 2, 2]
    df = spark.createDataFrame([(i, labels[i % 5]) for i in range(500)], "customer_id int, churn int")
    train, test = train_test_split(df, "churn", "customer_id")
    assert train.count() + test.count() == 500 and train.intersect(test).isEmpty()
    folds = with_folds(df, "churn", "customer_id", 5)
    assert folds.where("fold IS NULL").isEmpty()
    sizes = folds.groupBy("churn", "fold").count().groupBy("churn").agg(F.max("count") - F.min("count"), F.count("*"))
    assert sizes.count() == 4 and all(gap <= 2 and n == 5 for _, gap, n in sizes.collect())
    assert with_folds(df.where("false"), "churn", "customer_id").isEmpty()


def test_splits_do_not_depend_on_partitions(mart):
    def fold_map(df):
        return dict(
            with_folds(df, "churn", "customer_id").select("customer_id", "fold").collect()
        )

    assert fold_map(mart) == fold_map(mart.repartition(7))


def test_samples_are_nested(mart):
    small = stratified_sample(mart, "churn", "customer_id", 0.3).select("customer_id")
    large = stratified_sample(mart, "churn", "customer_id", 0.6).select("customer_id")
    assert small.subtract(large).isEmpty() and small.count() < large.count()
    only_one = mart.withColumn("churn", F.lit(0))
    rank = class_share_rank(only_one, "churn", "customer_id", 1, [0.5])
    assert only_one.where(rank.isNull()).isEmpty()


def test_compare_and_champion(spark, learnable):
    train, test = train_test_split(learnable, "churn", "customer_id")
    table, models = T.compare_models(
        train, test, {"gradient_boosting": pipeline("gradient_boosting", **GBT),
                      "random_forest": pipeline()},
    )
    rows = table.collect()
    assert [r["model"] for r in rows] == list(models)
    assert all(0.0 <= r["pr_auc"] <= 1.0 and r["roc_auc"] > 0.6 for r in rows)
    best = T.champion(table).first()
    assert best["roc_auc"] == max(r["roc_auc"] for r in rows)
    tie = spark.createDataFrame([(0, "a", 0.7), (1, "b", 0.7)],
                                "position int, model string, roc_auc double")
    assert T.champion(tie).first()["model"] == "a"


def test_halving_keeps_half_and_doubles_rows(learnable):
    model, params, history = T.halving_search(
        learnable, pipeline("random_forest", numTrees=3, maxDepth=3),
        {"maxDepth": [2, 3], "minInstancesPerNode": [1, 4]}, min_rows=40, folds=2,
    )
    by_rung = {}
    for rung, rows, candidate, auc in history:
        by_rung.setdefault(rung, []).append((rows, auc))
    alive = [len(by_rung[r]) for r in sorted(by_rung)]
    rows = [by_rung[r][0][0] for r in sorted(by_rung)]
    assert alive == [3, 2] and rows == [40, 80]
    assert set(params) == {"maxDepth", "minInstancesPerNode"}
    scores = model.transform(learnable).select(vector_to_array("probability")[1]).collect()
    assert all(0.0 <= s[0] <= 1.0 for s in scores)


def test_candidates_are_distinct():
    forest = T.make_classifier("random_forest")
    found = T.random_candidates(forest, T.SEARCH_SPACE["random_forest"], 1000)
    assert len({T.describe(c) for c in found}) == 3 * 4 * 3


def test_a_cut_ensemble_is_the_smaller_one(learnable):
    """Fewer trees and shallower trees, read off one fit, score as a fit of that size would."""
    for kind, large, small in (
        ("random_forest", {"numTrees": 8, "maxDepth": 9}, {"numTrees": 8, "maxDepth": 3}),
        ("gradient_boosting", {"maxIter": 6, "maxDepth": 3}, {"maxIter": 3, "maxDepth": 3}),
    ):
        *before, classifier = T.make_pipeline(kind, NUMERIC, ["plan_tier"], minInstancesPerNode=2).getStages()
        ready = written(Pipeline(stages=before).fit(learnable).transform(learnable).select("customer_id", "churn", T.WEIGHT, "features"), "ready")
        fits = [classifier.fit(ready, {classifier.getParam(n): v for n, v in p.items()}) for p in (large, small)]
        part = (8, 3) if kind == "random_forest" else (3, None)
        got = nested_scores(fits[0], ready, [(None, None), part], ["customer_id"]).collect()
        for position, model in enumerate(fits):
            want = dict(model.transform(ready).select("customer_id", vector_to_array("probability")[1]).collect())
            assert {r.customer_id: pytest.approx(r.probability, abs=1e-9) for r in got if r.position == position} == want


def test_a_forest_of_leading_trees(learnable):
    """The first trees of a forest, averaged by hand."""
    *before, classifier = T.make_pipeline("random_forest", NUMERIC, ["plan_tier"], numTrees=5, maxDepth=6).getStages()
    ready = written(Pipeline(stages=before).fit(learnable).transform(learnable).select("customer_id", "churn", T.WEIGHT, "features"), "ready")
    model = classifier.fit(ready)
    trees = [dict(t.transform(ready).select("customer_id", vector_to_array("probability")[1]).collect()) for t in model.trees[:2]]
    got = nested_scores(model, ready, [(2, None)], ["customer_id"]).collect()
    for r in got:
        assert r.probability == pytest.approx((trees[0][r.customer_id] + trees[1][r.customer_id]) / 2, abs=1e-9)


@pytest.mark.parametrize("metric", ["net_benefit", "f1", "brier"])
def test_search_and_importance_by_other_metrics(learnable, metric):
    small = pipeline("random_forest", numTrees=3, maxDepth=3)
    space = {"maxDepth": [1, 3], "numTrees": [1, 3]}
    value = "monthly_recurring_revenue"
    _, params, history = T.halving_search(learnable, small, space, min_rows=200, folds=2, candidates=4, metric=metric, value=value)
    best = max(history, key=lambda h: h[3])
    assert T.describe({T.make_classifier("random_forest").getParam(k): v for k, v in params.items()}) == best[2]
    importance = I.permutation_importance(
        T.fit_pipeline(small, learnable), learnable, [*NUMERIC, "plan_tier", *RATIO_ONLY], "churn", "customer_id", repeats=2,
        metric=metric, value=value,
    )
    assert I.top_features(importance, 1).first()["feature"] in ("monthly_recurring_revenue", "plan_tier")


RATIO_ONLY = ["contracted_seats", "active_users_last_30d", "support_tickets_count", "unresolved_tickets_count", "avg_daily_logins"]


def test_flow_from_accounts_to_scores(spark, learnable, tmp_path):
    """Search, champion, calibration, threshold, registry and scoring; the threshold is the registered one."""
    root = str(tmp_path / "models")
    row = W.train_and_register(
        learnable, root, ("random_forest", "logistic_regression"), NUMERIC, ["plan_tier"], folds=2, candidates=2,
        settings={"random_forest": FOREST},
    )
    assert row.algorithm in ("random_forest", "logistic_regression") and row.calibrated
    assert {"roc_auc", "pr_auc", "f1_score", "net_benefit_usd", "brier_score", "ece"} <= set(row.validation_metrics)
    scored = W.score_registered(spark, root, learnable.drop("churn"))
    rows = scored.collect()
    assert len(rows) == learnable.count() and {r.decision_threshold for r in rows} == {round(row.best_threshold, 4)}
    assert all(0.0 <= r.churn_probability <= 1.0 for r in rows)
    report, curve = W.calibration_report(scored.withColumn("y", F.col("churn_prediction")), "y", "churn_probability")
    assert report.first()["n_rows"] == len(rows) and curve.agg(F.sum("n")).first()[0] == len(rows)


def brute_isotonic(hits, weight):
    """Max-min form: the largest, over starts, of the least mean up to any later end."""
    n = len(hits)
    return [max(min(hits[a : b + 1].sum() / weight[a : b + 1].sum() for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_pooled_blocks(spark, seed):
    """Pooling by ranges and up the tree gives the max-min fit, whatever the ranges."""
    rng = np.random.default_rng(seed)
    score = np.round(rng.random(400), 2)
    label = (rng.random(400) < (score if seed else 0.5)).astype(int)
    df = spark.createDataFrame([*zip(score.tolist(), label.tolist()), (None, 1), (0.5, None)], "s double, y int").repartition(5)
    got = {r.score: (r.weight, r.calibrated) for r in C.calibrated_scores(df, "y", "s").collect()}
    points = np.unique(score)
    hits, weight = (np.array([f(label[score == p]) for p in points], float) for f in (np.sum, len))
    want = dict(zip(points.tolist(), zip(weight.tolist(), brute_isotonic(hits, weight))))
    assert set(got) == set(want)
    for p, (w, value) in want.items():
        assert got[p] == (w, pytest.approx(value, abs=1e-12))
    blocks = np.column_stack([points, points, hits, weight])
    for cut in (1, 17, len(points) - 1):
        parts = np.vstack([C.pool(blocks[:cut]), C.pool(blocks[cut:])])
        np.testing.assert_allclose(C.pool(parts), C.pool(blocks))


def test_isotonic_steps(spark):
    """Against pooling by hand: 0.2 and 0.3 violate the order and share their mean."""
    pairs = [(0.1, 0), (0.1, 0), (0.2, 1), (0.3, 0), (0.4, 1), (0.9, 1)]
    df = spark.createDataFrame(pairs, "s double, y int")
    model = C.fit_isotonic(df, "y", "s")
    fitted = dict(zip(model.boundaries.toArray(), model.predictions.toArray(), strict=True))
    assert fitted[0.1] == 0.0 and fitted[0.2] == 0.5 and fitted[0.3] == 0.5 and fitted[0.9] == 1.0


def test_sigmoid_fit(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(1.5 * x - 0.5)))).astype(int)
    df = spark.createDataFrame(list(zip(y.tolist(), x.tolist())), "y int, s double")
    slope, intercept = C.fit_sigmoid(df, "y", "s")
    assert slope == pytest.approx(1.5, abs=0.15) and intercept == pytest.approx(-0.5, abs=0.15)


@pytest.mark.parametrize("method", ["isotonic", "sigmoid"])
def test_calibrated_ensemble(spark, learnable, tmp_path, method):
    train, test = train_test_split(learnable, "churn", "customer_id")
    model = C.fit_calibrated(pipeline(), train, "churn", "customer_id", method, folds=2)
    scored = model.transform(test.drop("churn"))
    first = {r["customer_id"]: r["probability"] for r in scored.collect()}
    assert len(first) == test.count() and all(0.0 <= p <= 1.0 for p in first.values())
    assert set(test.drop("churn").columns) | {"probability"} == set(scored.columns)

    row = G.save_model(model, spark, str(tmp_path / "models"), "risk", "1.0", "random_forest",
                       NUMERIC, 0.35, validation_metrics={"roc_auc": 0.8})
    newer = G.save_model(model, spark, str(tmp_path / "models"), "risk", "1.1", "random_forest",
                         NUMERIC)
    found = G.latest(spark, str(tmp_path / "models"), "risk")
    assert found["version"] == "1.1" and found["path"] == newer.path
    assert G.registry(spark, str(tmp_path / "models")).count() == 2
    loaded = G.load_model(spark, row.path, row.checksum)
    second = {r["customer_id"]: r["probability"] for r in loaded.transform(test).collect()}
    assert second == first
    with pytest.raises(ValueError, match="checksum"):
        G.load_model(spark, row.path, "0" * 64)
    with pytest.raises(FileNotFoundError):
        G.load_model(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FileNotFoundError):
        G.latest(spark, str(tmp_path / "models"), "other")


def test_permutation_keeps_the_values(mart):
    shuffled = I.with_permuted(mart, ["contracted_seats", "plan_tier"], "customer_id", 2,
                               rows_per_block=40)
    rows = shuffled.select("customer_id", "contracted_seats", "plan_tier", "__permuted").collect()
    own = sorted((r["contracted_seats"], r["plan_tier"]) for r in rows)
    for repeat in range(2):
        drawn = [tuple(r["__permuted"][repeat]) for r in rows]
        assert sorted(drawn) == own
        assert drawn != [(r["contracted_seats"], r["plan_tier"]) for r in rows]
    first, second = ([tuple(r["__permuted"][i]) for r in rows] for i in range(2))
    assert first != second


def test_importance_finds_the_driver(learnable):
    model = pipeline().fit(learnable)
    used = [*NUMERIC, "plan_tier", "contracted_seats", "active_users_last_30d",
            "support_tickets_count", "unresolved_tickets_count", "avg_daily_logins"]
    importance = I.permutation_importance(model, learnable, used, "churn", "customer_id",
                                          repeats=3)
    top = I.top_features(importance, 2).collect()
    assert {r["feature"] for r in top} == {"monthly_recurring_revenue", "plan_tier"}
    assert [r["rank"] for r in top] == [1, 2]
    assert importance.count() == len(used)


def document_rows(spark, folder):
    """Labelled documents with a hash of the text as id, so exact copies stay on one side."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    words = F.split(F.lower(F.trim("text")), r"\s+")
    return written(
        documents.join(labels, "doc_id").select(
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            F.col("quality").cast("int").alias("quality"),
            F.log1p(F.col("n_chars").cast("double")).alias("log_chars"),
            (F.size(F.array_distinct(words)) / F.size(words)).alias("distinct_share"),
        ),
        "documents",
    )


def document_model(kind, **params):
    return Pipeline(
        stages=[
            T.BalancedWeights(inputCols=["quality"]),
            VectorAssembler(inputCols=["log_chars", "distinct_share"], outputCol="features"),
            T.make_classifier(kind, "quality", **params),
        ]
    )


def test_document_quality_is_learned(spark):
    """Holdout AUC on labelled documents; splits by text hash keep copies together."""
    docs = document_rows(spark, "/root/testdata/sf0.1")
    for seed in (1, 2):
        train, test = train_test_split(docs, "quality", "text_hash", 0.3, seed)
        negatives = test.where("quality = 0").count()
        for kind, params in (("random_forest", {**FOREST, "numTrees": 20}),
                             ("gradient_boosting", {**GBT, "maxIter": 10})):
            scored = document_model(kind, **params).fit(train).transform(test)
            rows = scored.select("quality", vector_to_array("probability")[1].alias("p"))
            auc = M.ranking_metrics(rows, "quality", "p").first()["roc_auc"]
            assert negatives > 50 and auc > 0.85, (seed, kind, negatives, auc)
