from __future__ import annotations

import numpy as np
import pytest

from accountrisk.operators.ordered import distinct_tallies, running_totals
from accountrisk.operators.quantiles import exact_quantiles
from pyspark.sql import functions as F

PROBS = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def frame(spark, **columns):
    rows = list(zip(*[[None if v is None else float(v) for v in c] for c in columns.values()]))
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in columns)).repartition(6)


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(7)
    n = 6000
    hot = rng.normal(50, 10, n)
    hot[: n // 3] = 48.5  # one value holds a third of the rows
    return {
        "normal": rng.normal(0, 1, n),
        "hot": hot,
        "few": rng.integers(0, 4, n).astype(float),
        "heavy": np.exp(rng.normal(0, 4, n)),
    }


@pytest.mark.parametrize("sort_limit", [1_000_000, 50])
def test_equal_to_numpy(spark, samples, sort_limit):
    """A tiny sort limit forces the sketch rounds; the answer must not change."""
    df = frame(spark, **samples)
    found = exact_quantiles(df, list(samples), PROBS, sort_limit=sort_limit, accuracy=200)
    for name, values in samples.items():
        np.testing.assert_allclose(found[name], np.quantile(values, PROBS), rtol=1e-12)


def test_nulls_nan_and_empty(spark):
    df = frame(spark, a=[1, None, 3, 10, float("nan"), 2], b=[None] * 6)
    found = exact_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75])
    np.testing.assert_allclose(found["a"], np.quantile([1, 2, 3, 10], [0.25, 0.5, 0.75]))
    assert found["b"] == [None, None, None]


@pytest.mark.parametrize("buckets", [2, 7, 40])
def test_running_totals_do_not_depend_on_buckets(spark, samples, buckets):
    values = samples["hot"][:1500]
    df = frame(spark, v=values)
    tallies = distinct_tallies(df, [], "v", {"n": F.count("*")}, buckets)
    rows = sorted(running_totals(tallies, [], "v", ["n"]).collect(), key=lambda r: r["v"])
    distinct, counts = np.unique(values, return_counts=True)
    assert [r["v"] for r in rows] == distinct.tolist()
    assert [r["n_before"] for r in rows] == (np.cumsum(counts) - counts).tolist()
    assert {r["n_total"] for r in rows} == {1500}
    assert [r["next_value"] for r in rows] == [*distinct[1:].tolist(), None]


@pytest.mark.parametrize("sort_limit", [1, 40, 5_000])
def test_a_value_that_fills_the_column(spark, sort_limit):
    """One value in nearly all rows and a long tail of distinct ones, on both sides and on one."""
    rng = np.random.default_rng(5)
    n = 30_000
    tail = np.zeros(n)
    tail[:900] = rng.permutation(900) + 1.0
    both = np.full(n, 2.5)
    both[:300] = rng.normal(2.5, 1, 300)
    ends = np.where(np.arange(n) < 40, np.inf, np.where(np.arange(n) > n - 40, -np.inf, rng.integers(0, 9, n)))
    df = frame(spark, tail=tail, both=both, ends=ends)
    probs = [0.0, 0.005, 0.01, 0.5, 0.96, 0.969, 0.9701, 0.99, 0.9999, 1.0]
    found = exact_quantiles(df, ["tail", "both"], probs, sort_limit=sort_limit, accuracy=100)
    for name, values in (("tail", tail), ("both", both)):
        np.testing.assert_allclose(found[name], np.quantile(values, probs), rtol=1e-12)
    assert exact_quantiles(df, ["ends"], [0.0, 0.5, 1.0], sort_limit)["ends"] == [-np.inf, np.sort(ends)[(n - 1) // 2], np.inf]


def test_no_interval_is_sorted_whole(spark, monkeypatch):
    """Running counts are taken within buckets; a window over a whole interval sees bucket totals only."""
    seen = []
    monkeypatch.setattr("accountrisk.operators.quantiles.running_totals", lambda t, *a: seen.append(t) or running_totals(t, *a))
    exact_quantiles(frame(spark, v=np.arange(4000.0)), ["v"], PROBS)
    (tallies,) = seen
    assert tallies.columns == ["slot", "bucket", "value", "n"]
    sizes = [r["count"] for r in tallies.groupBy("slot", "bucket").count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 1001
