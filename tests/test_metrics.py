from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from accountrisk.operators import metrics as M

# own vectors: a wave of probabilities, labels that mostly follow it
THRESHOLD_ROWS = [(int((7 * k) % 23 > 11), round(0.04 + 0.92 * ((7 * k) % 23) / 22, 3)) for k in range(17)]
CALIBRATION_ROWS = [(int(k % 3 == 0), round(0.07 * k + 0.03, 2)) for k in range(13)]


def rows(spark, pairs, **extra):
    names = list(extra)
    return spark.createDataFrame(
        [(int(y), float(p), *extra.values()) for y, p in pairs],
        ", ".join(["y int", "p double", *[f"{n} double" for n in names]]),
    )


def benefit(spark, y, pred, ltv):
    df = spark.createDataFrame([(y, pred, ltv)], "y int, pred int, ltv double")
    return df.agg(M.net_benefit(F.col("y"), F.col("pred"), F.col("ltv"))).first()[0]


def test_net_benefit_goldens(spark):
    ltv = 4_321.0
    assert benefit(spark, 1, 1, ltv) == pytest.approx(0.65 * ltv - 150)
    assert benefit(spark, 0, 1, ltv) == -150.0
    assert benefit(spark, 1, 0, ltv) == -ltv
    assert benefit(spark, 0, 0, ltv) == 0.0


def test_default_value_and_evaluator(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0)], "churn int, prediction double")
    assert M.NetBenefitEvaluator().evaluate(df) == pytest.approx(0.65 * 10_200 - 300)
    assert M.NetBenefitEvaluator().isLargerBetter()


def brute_curve(pairs, mrr):
    out = []
    for t in M.default_thresholds():
        tp = sum(1 for y, p in pairs if y == 1 and p >= t)
        fp = sum(1 for y, p in pairs if y == 0 and p >= t)
        fn = sum(1 for y, p in pairs if y == 1 and p < t)
        ltv = mrr * 12
        out.append((tp, fp, fn, round(tp * (0.65 * ltv - 150) - fp * 150 - fn * ltv, 2)))
    return out


def test_curve_matches_per_threshold_loop(spark):
    curve = M.financial_curve(rows(spark, THRESHOLD_ROWS, mrr=500.0), "y", "p", "mrr")
    found = sorted(curve.collect(), key=lambda r: r["position"])
    assert [(r["tp"], r["fp"], r["fn"], r["net_benefit_usd"]) for r in found] == brute_curve(
        THRESHOLD_ROWS, 500.0
    )
    assert found[0]["threshold"] == 0.05 and found[-1]["threshold"] == 0.95


def test_first_maximum_wins(spark):
    curve = M.financial_curve(rows(spark, THRESHOLD_ROWS, mrr=500.0), "y", "p", "mrr")
    best = M.best_threshold(curve).first()
    benefits = [b for *_, b in brute_curve(THRESHOLD_ROWS, 500.0)]
    assert best["max_net_benefit_usd"] == max(benefits)
    assert best["best_threshold"] == M.default_thresholds()[benefits.index(max(benefits))]


def test_calibration_goldens(spark):
    df = rows(spark, CALIBRATION_ROWS)
    squares = [(p - y) ** 2 for y, p in CALIBRATION_ROWS]
    assert df.agg(M.brier(F.col("y"), F.col("p"))).first()[0] == pytest.approx(sum(squares) / len(squares))
    gap = 0.0
    for k in range(5):
        inside = [(y, p) for y, p in CALIBRATION_ROWS if k / 5 <= p < (k + 1) / 5 or k == 4 and p == 1]
        gap += abs(sum(y - p for y, p in inside)) / len(CALIBRATION_ROWS)
    assert M.calibration_error(df, "y", "p", 5).first()[0] == pytest.approx(gap)


def test_bin_edges_follow_floating_multiples(spark):
    df = rows(spark, [(1, 0.3), (1, 0.5), (1, 1.0)])
    # 3 * 0.1 is just above 0.3, so 0.3 stays in bin 2; the curve puts 0.5 into the lower bin
    from accountrisk.functions.numeric import edges_reached

    inner = M.uniform_edges(10)[1:-1]
    assert [r[0] for r in df.select(edges_reached(F.col("p"), inner)).collect()] == [2, 5, 9]
    curve = {r["bin"] for r in M.reliability_curve(df, "y", "p").collect()}
    assert curve == {2, 4, 9}


def brute_auc(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(pairs):
    total, last = 0.0, 0.0
    n_pos = sum(y for y, _ in pairs)
    for cut in sorted({p for _, p in pairs}, reverse=True):
        kept = [y for y, p in pairs if p >= cut]
        recall, precision = sum(kept) / n_pos, sum(kept) / len(kept)
        total += (recall - last) * precision
        last = recall
    return total


@pytest.mark.parametrize("buckets", [2, 9])
def test_ranking_metrics_with_ties_and_a_hot_score(spark, buckets):
    rng = random.Random(3)
    pairs = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(400)]
    pairs += [(int(rng.random() < 0.5), 0.42) for _ in range(200)]
    df = rows(spark, pairs).repartition(5)
    found = M.ranking_metrics(df, "y", "p", buckets=buckets).first()
    assert found["roc_auc"] == pytest.approx(brute_auc(pairs), abs=1e-12)
    assert found["pr_auc"] == pytest.approx(brute_ap(pairs), abs=1e-12)
    squared = df.withColumn("p", F.col("p") * F.col("p"))
    assert M.ranking_metrics(squared, "y", "p").first()["roc_auc"] == pytest.approx(
        found["roc_auc"], abs=1e-12
    )


def test_ranking_metrics_per_key_and_single_class(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.2), ("b", 0, 0.8), ("c", 1, 0.5)],
        "k string, y int, p double",
    )
    found = {r["k"]: r["roc_auc"] for r in M.ranking_metrics(df, "y", "p", ["k"]).collect()}
    assert found == {"a": 1.0, "b": 0.0, "c": None}


def test_f1_and_weights(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "y int, hit int")
    assert df.agg(M.f1_score(F.col("y"), F.col("hit"))).first()[0] == 0.5
    nothing = spark.createDataFrame([(0, 0)], "y int, hit int")
    assert nothing.agg(M.f1_score(F.col("y"), F.col("hit"))).first()[0] == 0.0
    weights = {r["y"]: r["weight"] for r in M.class_weights(df, "y").collect()}
    assert weights == {1: pytest.approx(1.25), 0: pytest.approx(5 / 6)}
    table = M.confusion(df, "y", "hit").first()
    assert (table["tp"], table["fp"], table["fn"], table["tn"]) == (1, 1, 1, 2)
