"""The halving search: its query uses the operator's own settings, its candidates do not follow the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as wiring
from accountrisk.operators import training as T
from accountrisk.session import written
from conftest import SMALL


def test_halving_query_uses_the_full_grid_rows_and_folds(spark, monkeypatch):
    asked = {}

    def search(df, pipeline, space, **options):
        asked.update(options, space=space)
        return None, {}, [(0, 1000, "none", 0.5)]

    monkeypatch.setattr(T, "halving_search", search)
    assert wiring.queries()["q_ml_halving_search"](spark, SMALL).count() == 1
    assert asked == {"space": T.SEARCH_SPACE["random_forest"], "min_rows": 1000, "folds": 5, "candidates": 6}


def test_halving_query_runs(spark):
    """The query itself, at full settings on the smallest data: one rung, its candidates scored."""
    rows = wiring.queries()["q_ml_halving_search"](spark, SMALL).collect()
    assert len(rows) == 6 and {r.rung for r in rows} == {0} and all(0.0 <= r.metric <= 1.0 for r in rows)
    assert len({r.candidate for r in rows}) == 6


def test_halving_starts_with_the_candidates_asked_for(mart):
    rows = written(mart.withColumn("churn", F.pmod(F.xxhash64("customer_id"), F.lit(2)).cast("int")), "halves")
    space = {"maxDepth": [2, 3], "minInstancesPerNode": [1, 4]}
    small = T.make_pipeline("random_forest", ["nps_score"], ["plan_tier"], numTrees=2, maxDepth=2)
    _, _, history = T.halving_search(rows, small, space, min_rows=1000, folds=2, candidates=4)
    assert [rung for rung, *_ in history] == [0] * 4 and len({c for _, _, c, _ in history}) == 4
    _, _, history = T.halving_search(rows, small, space, min_rows=40, folds=2, candidates=4)
    assert [(rung, n) for rung, n, *_ in history] == [(0, 40)] * 4 + [(1, 80)] * 2 + [(2, min(160, rows.count()))]
