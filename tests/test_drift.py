from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountrisk.operators import drift as D
from accountrisk.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from accountrisk.sources.accounts import append_report, load_baseline, save_baseline
from feeds import shifted_batch


def column(spark, values, name="v", kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}").repartition(3)


def numbers(spark, values):
    return column(spark, [None if v is None else float(v) for v in values])


def psi(spark, a, b):
    return D.psi_numeric(numbers(spark, a), numbers(spark, b), ["v"]).first()["psi"]


def ks(spark, a, b):
    return D.distribution_distances(numbers(spark, a), numbers(spark, b), ["v"]).first()


def numpy_psi(a, b):
    edges = np.unique(np.quantile(a, [i / 10 for i in range(11)]))
    edges[0], edges[-1] = -np.inf, np.inf
    n, m = np.histogram(a, edges)[0], np.histogram(b, edges)[0]
    p = (n + 1e-4) / (n.sum() + 1e-4 * len(n))
    q = (m + 1e-4) / (m.sum() + 1e-4 * len(n))
    return float(np.sum((q - p) * np.log(q / p)))


def test_psi_golden_and_bins(spark):
    a, b = range(1, 101), range(51, 151)
    assert psi(spark, a, b) == pytest.approx(6.652276777664003, abs=1e-12)
    ref, cur = numbers(spark, a), numbers(spark, b)
    edges = D.bin_edges(ref, ["v"])
    counts = D.bin_counts(D.tagged_numbers(ref, cur, ["v"]), edges).collect()
    found = {r["bin"]: r["n_cur"] for r in counts}
    assert [found[i] for i in range(10)] == [0, 0, 0, 0, 0, 10, 10, 10, 10, 60]


def test_psi_samples(spark):
    rng = np.random.default_rng(1)
    a, same, moved = rng.gamma(3, 4, 1700), rng.gamma(3, 4, 1700), rng.gamma(5, 5, 1300)
    assert psi(spark, a, same) < 0.05
    assert psi(spark, a, moved) > 0.25
    assert psi(spark, a, moved) == pytest.approx(numpy_psi(a, moved), abs=1e-12)
    assert psi(spark, a, a) == 0.0


def test_psi_edge_cases(spark):
    assert psi(spark, [5] * 10, [5] * 7) == 0.0
    assert psi(spark, [5] * 10, [6] * 7) == 1.0
    assert psi(spark, [5] * 10, [1, 2, 3]) == 0.0  # a constant reference has no bins
    assert psi(spark, [1, 2, 3], [None, None]) == 0.0
    assert psi(spark, [None], [1, 2]) == 0.0
    assert psi(spark, [0] * 99 + [7], [0, 7, 7]) == 0.0  # two edges make one bin


def test_ks(spark):
    golden = ks(spark, range(1, 101), range(51, 151))
    assert golden["ks_statistic"] == pytest.approx(0.5)
    assert golden["wasserstein"] == pytest.approx(50.0)
    rng = np.random.default_rng(2)
    a, same, moved = rng.uniform(-3, 8, 750), rng.uniform(-3, 8, 750), rng.uniform(0, 9, 640)
    assert ks(spark, a, same)["ks_pvalue"] > 0.05
    assert ks(spark, a, moved)["ks_pvalue"] < 0.05
    too_few = ks(spark, [1.0], [2.0, 3.0])
    assert (too_few["ks_statistic"], too_few["ks_pvalue"]) == (0.0, 1.0)
    empty = ks(spark, [None], [2.0, 3.0])
    assert (empty["ks_statistic"], empty["ks_pvalue"]) == (0.0, 1.0)


def test_ks_with_a_hot_value(spark):
    rng = np.random.default_rng(3)
    a = np.concatenate([np.full(500, 3.0), rng.normal(3, 1, 1000)])
    b = np.concatenate([np.full(100, 3.0), rng.normal(3.4, 1, 900)])
    points = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    found = ks(spark, a, b)
    assert found["ks_statistic"] == pytest.approx(np.abs(fa - fb).max(), abs=1e-12)
    area = float(np.sum(np.abs(fa - fb)[:-1] * np.diff(points)))
    assert found["wasserstein"] == pytest.approx(area, abs=1e-9)


def enumerated_pvalue(limit, n, m):
    """Share of all orders of n + m values whose distance reaches limit / (n * m)."""
    hits = total = 0
    for chosen in itertools.combinations(range(n + m), n):
        i = worst = 0
        for k in range(n + m):
            i += k in chosen
            worst = max(worst, abs(i * m - (k + 1 - i) * n))
        hits, total = hits + (worst >= limit), total + 1
    return hits / total


def test_exact_pvalues_by_enumeration(spark):
    cases = [(h, n, m) for n in (2, 3, 5, 8) for m in (2, 4, 7, 8) for h in (0, 1, n, m, n * m // 2, n * m)]
    want = [enumerated_pvalue(h, n, m) if h else 1.0 for h, n, m in cases]
    assert [D.exact_pvalue(h / (n * m), n, m) for h, n, m in cases] == pytest.approx(want, abs=1e-12)
    df = spark.createDataFrame([(h / (n * m), n, m) for h, n, m in cases[:20]] + [(0.01, 20_000, 500), (None, 3, 4)], "d double, n bigint, m bigint")
    rows = df.select("*", D.ks_pvalue(F.col("d"), F.col("n"), F.col("m")).alias("p"), D.asymptotic_pvalue(F.col("d"), F.col("n"), F.col("m")).alias("a")).collect()
    assert [r.p for r in rows[:20]] == pytest.approx(want[:20], abs=1e-12)
    assert rows[20].p == rows[20].a and rows[21].p is None


# Published distances of one audit: (distance, reference rows, current rows, p-value)
PUBLISHED = [
    (0.0309, 10_000, 800, 0.4702), (0.0398, 10_000, 800, 0.1853), (0.0262, 10_000, 800, 0.6774),
    (0.026, 10_000, 800, 0.6888), (0.0269, 10_000, 800, 0.6453), (0.0427, 10_000, 800, 0.1306),
    (0.861, 10_000, 800, 0.0), (0.0111, 10_000, 800, 1.0), (0.5801, 8_800, 704, 0.0),
    (0.191, 10_000, 800, 0.0), (0.0475, 9_700, 776, 0.0755),
]


def test_pvalues_of_a_published_audit(spark):
    df = spark.createDataFrame(PUBLISHED, "d double, n bigint, m bigint, p double")
    gaps = df.select(F.abs(D.ks_pvalue(F.col("d"), F.col("n"), F.col("m")) - F.col("p")))
    assert max(r[0] for r in gaps.collect()) < 0.01


def test_categorical_psi(spark):
    def plans(*counts):
        names = ["Starter", "Professional", "Enterprise"]
        values = [n for n, c in zip(names, counts, strict=True) for _ in range(c)]
        return column(spark, values, "plan", "string")

    ref = plans(500, 300, 200)
    moved = D.psi_categorical(ref, plans(100, 100, 800), ["plan"]).first()["psi"]
    assert moved == pytest.approx(1.6952730524642985, abs=1e-12)
    assert D.psi_categorical(ref, plans(500, 300, 200), ["plan"]).first()["psi"] == 0.0
    empty = column(spark, [None], "plan", "string")
    assert D.psi_categorical(ref, empty, ["plan"]).first()["psi"] == 0.0


def test_verdict_levels(spark):
    df = spark.createDataFrame(
        [("a", 0.3, 0.0, 1.0), ("b", 0.1, 0.2, 0.01), ("c", 0.05, 0.15, 0.01),
         ("d", 0.12, None, None)],
        "feature string, psi double, ks_statistic double, ks_pvalue double",
    )
    found = {r["feature"]: (r["drift_level"], r["has_drift"])
             for r in D.feature_verdict(df).collect()}
    assert found == {
        "a": ("DRIFT_DETECTED", True), "b": ("WARNING", True), "c": ("STABLE", False),
        "d": ("WARNING", False),
    }
    whole = D.dataset_verdict(D.feature_verdict(df)).first()
    assert whole["is_dataset_drifted"] and whole["drifted_features"] == ["a", "b"]
    nothing = D.dataset_verdict(D.feature_verdict(df.where("1 = 0"))).first()
    assert not nothing["is_dataset_drifted"] and nothing["total_features_evaluated"] == 0


def test_report_on_stable_and_shifted_batches(spark, mart, tmp_path):
    stable = D.drift_report(mart, mart, NUMERIC_FEATURES, CATEGORICAL_FEATURES).first()
    assert not stable["is_dataset_drifted"] and stable["total_features_evaluated"] == 17
    assert {m["psi"] for m in stable["feature_metrics"]} == {0.0}

    severe = mart.withColumns(
        {"nps_score": F.lit(0.0), "plan_tier": F.lit("Enterprise"),
         "monthly_recurring_revenue": F.col("monthly_recurring_revenue") * 5}
    )
    report = D.drift_report(mart, severe, NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    row = report.first()
    assert row["is_dataset_drifted"]
    assert set(row["drifted_features"]) >= {
        "nps_score", "monthly_recurring_revenue", "plan_tier"
    }
    path = append_report(report, str(tmp_path / "reports"))
    append_report(report, path)
    back = spark.read.schema(report.schema).json(path)
    assert back.count() == 2 and len(back.first()["feature_metrics"]) == 17


def test_absent_features(spark, mart):
    current = mart.drop("nps_score", "industry")
    rows = D.feature_report(mart.drop("plan_tier", "invoice_delay_days"), current,
                            NUMERIC_FEATURES, CATEGORICAL_FEATURES).collect()
    found = {r["feature"]: r for r in rows}
    assert len(found) == 15 and "nps_score" not in found
    assert found["plan_tier"]["psi"] == 0.0 and found["plan_tier"]["ks_pvalue"] is None
    assert found["invoice_delay_days"]["ks_pvalue"] == 1.0


def test_stored_baseline_gives_the_same_index(spark, mart, tmp_path):
    current = shifted_batch(mart)
    direct = {r["feature"]: r["psi"]
              for r in D.psi_numeric(mart, current, NUMERIC_FEATURES).collect()}
    path = save_baseline(D.baseline_bins(mart, NUMERIC_FEATURES), None, str(tmp_path / "base"))
    stored = D.psi_from_baseline(load_baseline(spark, path, "numeric"), current).collect()
    assert {r["feature"]: r["psi"] for r in stored} == pytest.approx(direct, abs=1e-12)
    with pytest.raises(ValueError):
        save_baseline(None, None, str(tmp_path / "none"))


def test_stored_categories_give_the_same_index(spark, mart, tmp_path):
    """Also for categories that one side lacks, and a feature the batch lacks."""
    current = shifted_batch(mart, plan="Trial").drop("industry")
    named = [f for f in CATEGORICAL_FEATURES if f != "industry"]
    direct = {r["feature"]: r["psi"] for r in D.psi_categorical(mart, current, named).collect()}
    path = save_baseline(None, D.categorical_profile(mart, CATEGORICAL_FEATURES), str(tmp_path / "base"))
    stored = D.categorical_psi_from_baseline(load_baseline(spark, path, "categorical"), current).collect()
    assert {r["feature"]: r["psi"] for r in stored} == pytest.approx(direct, abs=1e-12)


def test_profiles(spark, mart):
    pdf = mart.toPandas()
    for row in D.numeric_profile(mart, [*NUMERIC_FEATURES, "not_there"]).collect():
        series = pdf[row["feature"]].dropna().astype(float)
        assert row["mean"] == pytest.approx(series.mean())
        assert row["std"] == pytest.approx(series.std())
        assert row["p95"] == pytest.approx(series.quantile(0.95))
    shares = D.categorical_profile(mart, ["plan_tier"]).collect()
    assert math.isclose(sum(r["proportion"] for r in shares), 1.0)
    assert {r["unique_count"] for r in shares} == {3}
