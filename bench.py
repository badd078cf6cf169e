"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from accountrisk.operators.splits import train_test_split
from accountrisk.operators.training import fit_pipeline, make_pipeline
from accountrisk.plans import load_catalog
from accountrisk.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from accountrisk.session import build_session, written
from accountrisk.sources.mart import account_mart

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))

HEADLINE = [
    "q_join_account_mart",
    "q_dq_contract_gate",
    "q_feat_ratios",
    "q_feat_winsor_apply",
    "q_feat_target_encode",
    "q_score_batch",
    "q_score_response",
    "q_agg_portfolio_by_tier",
    "q_agg_financial_curve",
    "q_agg_roc_auc",
    "q_agg_ece",
    "q_sort_by_risk",
    "q_win_risk_rank",
    "q_drift_psi_numeric",
    "q_drift_ks_stat",
    "q_drift_report",
    "q_stream_gate_score",
    "q_drift_wasserstein",
]


def run(query, spark) -> float:
    """Wall time of building and fully evaluating one query, without collecting its rows."""
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def fit_and_score(spark) -> dict[str, float]:
    """A forest at its full settings: fitting and scoring timed apart."""
    start = time.perf_counter()
    mart = written(account_mart(spark, SF_DIR), "bench-mart")
    train, test = train_test_split(mart, "churn", "customer_id")
    model = fit_pipeline(make_pipeline("random_forest", NUMERIC_FEATURES, CATEGORICAL_FEATURES), train)
    fitted = time.perf_counter()
    model.transform(mart).write.format("noop").mode("overwrite").save()
    return {"model_fit": round(fitted - start, 3), "model_score": round(time.perf_counter() - fitted, 3)}


def main() -> None:
    spark = build_session(
        "accountrisk-bench",
        f"local[{CPUS}]",
        {
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    catalog, _ = load_catalog()
    run(catalog["q_agg_portfolio_by_tier"], spark)  # JVM warm-up
    seconds = {name: round(run(catalog[name], spark), 3) for name in HEADLINE}
    seconds |= fit_and_score(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
