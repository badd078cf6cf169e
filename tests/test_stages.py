from __future__ import annotations

import random

import numpy as np
import pytest

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from accountrisk.operators import encoding
from accountrisk.operators import stages as S
from accountrisk.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES


def doubles(spark, values, name="v"):
    rows = [(None if v is None else float(v),) for v in values]
    return spark.createDataFrame(rows, f"{name} double")


def out(df, name="v"):
    return [r[name] for r in df.collect()]


def test_winsorizer_clips_an_outlier_and_keeps_nulls(spark):
    train = doubles(spark, [*range(100), 9999])
    model = S.Winsorizer(inputCols=["v"], lower=0.05, upper=0.95).fit(train)
    low, high = model.learned()["v"]
    assert [low, high] == np.quantile([*range(100), 9999], [0.05, 0.95]).tolist()
    assert out(model.transform(doubles(spark, [-5, None, 9999]))) == [low, None, high]


def test_log1p(spark):
    df = S.Log1p(inputCols=["v", "absent"]).transform(doubles(spark, [-5, None, 0, np.e - 1]))
    assert out(df) == [0.0, 0.0, 0.0, pytest.approx(1.0)]


def test_imputer_and_scalers(spark):
    df = doubles(spark, [1, 2, 3, 10, None])
    assert out(S.MedianImputer(inputCols=["v"]).fit(df).transform(df))[-1] == 2.5
    robust = S.RobustColumnScaler(inputCols=["v"]).fit(df)
    assert robust.learned()["v"] == [2.5, 3.0]
    standard = S.StandardColumnScaler(inputCols=["v"]).fit(df)
    assert standard.learned()["v"] == [4.0, pytest.approx(np.std([1, 2, 3, 10]))]
    constant = doubles(spark, [7, 7])
    assert out(S.RobustColumnScaler(inputCols=["v"]).fit(constant).transform(constant)) == [0, 0]


def test_one_hot(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", "x")], "k string, two string")
    model = S.OneHot(inputCols=["k", "two"]).fit(df)
    assert model.feature_names() == ["k=a", "k=b", "k=c", "two=y"]
    new = spark.createDataFrame([("c", "y"), ("new", "new"), (None, None)], "k string, two string")
    rows = model.transform(new).collect()
    assert [r["k__hot"].toArray().tolist() for r in rows] == [[0, 0, 1], [0, 0, 0], [0, 0, 0]]
    assert [r["two__hot"].toArray().tolist() for r in rows] == [[1], [0], [0]]


@pytest.mark.parametrize("scaler", ["robust", "standard"])
@pytest.mark.parametrize("winsorize", [True, False])
def test_fused_preparation_equals_the_separate_stages(spark, mart, scaler, winsorize):
    base = S.NumericCopies(inputCols=NUMERIC_FEATURES).transform(mart)
    num = [f"num__{c}" for c in NUMERIC_FEATURES]
    scale = S.RobustColumnScaler if scaler == "robust" else S.StandardColumnScaler
    steps = [S.MedianImputer(inputCols=num)]
    if winsorize:
        steps.append(S.Winsorizer(inputCols=num))
    steps += [S.Log1p(inputCols=num[:4]), scale(inputCols=num)]
    separate = Pipeline(stages=steps).fit(base).transform(base)
    fused = S.NumericPreparation(
        inputCols=num, logged=num[:4], scaler=scaler, winsorize=winsorize
    ).fit(base).transform(base)
    left = separate.select("customer_id", *num).toPandas().sort_values("customer_id")
    right = fused.select("customer_id", *num).toPandas().sort_values("customer_id")
    np.testing.assert_allclose(left[num].to_numpy(), right[num].to_numpy(), rtol=1e-9, atol=1e-12)


def test_preprocessor_matrix_is_complete_and_survives_saving(spark, mart, tmp_path):
    fitted = S.build_preprocessor(
        NUMERIC_FEATURES, CATEGORICAL_FEATURES, target_encoded=["industry"]
    ).fit(mart)
    path = str(tmp_path / "pre")
    fitted.write().save(path)
    loaded = PipelineModel.load(path)

    def matrix(model):
        rows = model.transform(mart).select("customer_id", vector_to_array("features").alias("x"))
        return np.array([r["x"] for r in sorted(rows.collect(), key=lambda r: r["customer_id"])])

    first = matrix(fitted)
    # 15 numeric, 3 + 5 + 5 + 3 + 5 indicators, one for the two-valued flag, one target encoding
    assert first.shape == (mart.count(), 15 + 21 + 1 + 1)
    assert np.isfinite(first).all()
    np.testing.assert_array_equal(first, matrix(loaded))
    assert set(mart.columns) <= set(fitted.transform(mart).columns)


def test_log_features_limit_the_log_step(mart):
    stages = S.preprocessor_stages(NUMERIC_FEATURES, [], log_features=["nps_score"])
    preparation = next(s for s in stages if isinstance(s, S.NumericPreparation))
    assert preparation.getOrDefault(preparation.logged) == ["num__nps_score"]
    with pytest.raises(ValueError):
        S.preprocessor_stages(NUMERIC_FEATURES, [], scaler="none")


def brute_encoding(rows, fold):
    used = [r for r in rows if r["f"] != fold]
    y = np.array([r["y"] for r in used], dtype=float)
    result = {}
    for k in {r["k"] for r in used}:
        own = np.array([r["y"] for r in used if r["k"] == k], dtype=float)
        pull = y.var() * len(own)
        bottom = pull + own.var()
        weight = pull / bottom if bottom else 0.0
        result[k] = weight * own.mean() + (1 - weight) * y.mean()
    return result, y.mean()


@pytest.fixture(scope="module")
def categories(spark):
    rng = np.random.default_rng(5)
    keys = ["hot"] * 150 + [f"k{i % 7}" for i in range(149)] + ["lonely"]
    rows = [(i, k, int(rng.random() < 0.4), i % 3) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "id int, k string, y int, f int")


def test_target_encoding_out_of_fold(spark, categories):
    rows = categories.collect()
    table = encoding.encoding_table(categories, "k", "y", "f")
    encoded = encoding.encode(categories, table, "k", "e", "f").collect()
    assert len(encoded) == len(rows)
    for row in encoded:
        by_key, mean = brute_encoding(rows, row["f"])
        assert row["e"] == pytest.approx(by_key.get(row["k"], mean), abs=1e-12)


def test_target_encoding_of_new_rows(spark, categories):
    model = encoding.TargetEncoder(inputCol="k", outputCol="e", labelCol="y", foldCol="f").fit(
        categories
    )
    by_key, mean = brute_encoding(categories.collect(), fold=None)
    new = spark.createDataFrame([("hot",), ("unseen",)], "k string")
    found = {r["k"]: r["e"] for r in model.transform(new).collect()}
    assert found["hot"] == pytest.approx(by_key["hot"], abs=1e-12)
    assert found["unseen"] == pytest.approx(mean, abs=1e-12)


def test_target_encoding_needs_folds(spark, categories):
    with pytest.raises(ValueError, match="fold"):
        encoding.TargetEncoder(inputCol="k", outputCol="e", labelCol="y").fit(categories)


def test_many_categories(spark):
    """20,000 categories: a slot each, unseen ones and nulls empty, vectors sparse."""
    df = spark.range(20_000).select(F.format_string("c%05d", "id").alias("k"))
    model = S.OneHot(inputCols=["k"]).fit(df)
    asked = spark.createDataFrame([("c00000",), ("c19999",), ("none",), (None,)], "k string")
    rows = {r["k"]: r["k__hot"] for r in model.transform(asked).collect()}
    assert {v.size for v in rows.values()} == {20_000}
    assert [rows[k].indices.tolist() for k in ("c00000", "c19999", "none", None)] == [[0], [19_999], [], []]
    assert model.transform(asked).columns == ["k", "k__hot"]


def test_nulls_do_not_reach_the_assembler(spark, mart):
    holes = mart.withColumn("monthly_recurring_revenue", F.lit(None).cast("double"))
    fitted = S.build_preprocessor(NUMERIC_FEATURES, []).fit(holes)
    assert fitted.transform(holes).select("features").count() == mart.count()


def test_a_random_label_cannot_be_read_off_its_encoding(spark):
    """Every category stands once: in-sample means would be the label itself."""
    rng = random.Random(4)
    rows = [(i, f"only{i}", int(rng.random() < 0.5)) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id int, k string, churn int")
    seen = []

    class Spy(Estimator):
        def _fit(self, dataset):
            seen.extend(dataset.select("churn", "te__k").collect())
            return S.CategoryCopies(inputCols=["k"])

    stages = [S.CategoryCopies(inputCols=["k"]), S.TargetEncoder(inputCol="cat__k", outputCol="te__k", labelCol="churn"), Spy()]
    model = S.pipeline_of(stages, ["k"]).fit(df)
    means = {y: np.mean([r["te__k"] for r in seen if r["churn"] == y]) for y in (0, 1)}
    assert abs(means[1] - means[0]) < 0.05
    assert "te_fold" not in model.transform(df).columns
