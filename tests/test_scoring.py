from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from accountrisk.functions.ratios import EPSILON, with_ratios
from accountrisk.functions.scoring import (
    ACTIONS,
    financial_evaluation,
    log_odds,
    priority_band,
    response,
    rule_probability,
    score_accounts,
    top_factors,
)
from accountrisk.operators.portfolio import portfolio_by_tier, portfolio_summary, ranked_within
from accountrisk.schema import RATIO_INPUTS


def test_ratio_golden(accounts):
    row = with_ratios(accounts()).first()
    assert row["seat_utilization_rate"] == 8 / 64
    assert row["unresolved_tickets_ratio"] == pytest.approx(3 / (7 + EPSILON), abs=1e-15)
    assert row["avg_logins_per_active_user"] == pytest.approx(6 / (8 + EPSILON), abs=1e-15)
    assert row["mrr_per_contracted_seat"] == 32.5


def test_ratio_bounds_and_nulls(accounts):
    rows = with_ratios(
        accounts(
            {"active_users_last_30d": 500, "contracted_seats": 10},
            {"contracted_seats": 0, "unresolved_tickets_count": 99},
            {"active_users_last_30d": None},
        )
    ).collect()
    assert rows[0]["seat_utilization_rate"] == 1.5
    assert rows[1]["unresolved_tickets_ratio"] == 1.0
    assert rows[1]["mrr_per_contracted_seat"] == 2080.0
    assert rows[2]["seat_utilization_rate"] is None
    assert rows[2]["avg_logins_per_active_user"] is None


def test_ratios_need_their_inputs(spark, accounts):
    with pytest.raises(ValueError, match="missing"):
        with_ratios(spark.createDataFrame([(1,)], "col_a int"))
    dropped = with_ratios(accounts(), drop_intermediates=True)
    assert not set(RATIO_INPUTS) & set(dropped.columns)


def expected_log_odds(a):
    z = -2.8 + (1 - a["active_users_last_30d"] / a["contracted_seats"]) * 2.2
    z += a["invoice_delay_days"] / 15 * 1.5
    z += a["unresolved_tickets_count"] / (a["support_tickets_count"] + 1) * 2
    z += 0.6 if a["billing_cycle"] == "Monthly" else -0.4
    z += -0.3 if a["auto_renew_enabled"] else 0.8
    z += 1.4 if a["nps_score"] is not None and a["nps_score"] <= 5 else -0.5
    z += 1.2 if a["feature_adoption_score"] < 40 else -0.4
    z += -0.7 if a["plan_tier"] == "Enterprise" else 0.1
    return z - a["contract_duration_months"] / 36


def test_log_odds_by_hand(accounts):
    df = accounts({}, {"nps_score": None, "plan_tier": "Starter", "auto_renew_enabled": True})
    for row in df.select("*", log_odds().alias("z"), rule_probability().alias("p")).collect():
        z = expected_log_odds(row.asDict())
        assert row["z"] == pytest.approx(z, abs=1e-12)
        assert row["p"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-12)


def test_top_factors_fall(accounts):
    (factors,) = accounts().select(top_factors(3)).first()
    values = [f["contribution"] for f in factors]
    assert len(factors) == 3 and values == sorted(values, reverse=True)
    assert factors[0]["factor"] == "payment_delay"


def scored_at(spark, probabilities, threshold):
    rows = [(i, p, 100.0) for i, p in enumerate(probabilities)]
    df = spark.createDataFrame(rows, "customer_id int, p double, monthly_recurring_revenue double")
    return score_accounts(df, F.col("p"), threshold)


def test_tiers_and_prediction_edges(spark):
    rows = scored_at(spark, [0.19, 0.2, 0.34999, 0.35, 0.7, 0.199996], 0.35).collect()
    assert [r["risk_level"] for r in rows] == ["LOW", "MEDIUM", "HIGH", "HIGH", "CRITICAL",
                                               "MEDIUM"]
    # the prediction looks at the unrounded probability, the tier at the rounded one
    assert [r["churn_prediction"] for r in rows] == [0, 0, 0, 1, 1, 0]


def test_low_threshold_leaves_medium_empty(spark):
    rows = scored_at(spark, [0.04, 0.1, 0.2, 0.9], 0.05).collect()
    assert [(r["risk_level"], r["churn_prediction"]) for r in rows] == [
        ("LOW", 0), ("LOW", 1), ("HIGH", 1), ("CRITICAL", 1)
    ]


def test_rounding_is_half_even(spark):
    assert [r["churn_probability"] for r in scored_at(spark, [0.00005, 0.00015], 0.5).collect()] \
        == [0.0, 0.0002]


def test_money_and_response(spark):
    rows = response(scored_at(spark, [0.5, 0.1], 0.35)).collect()
    money = rows[0]["financial_evaluation"]
    assert money["estimated_annual_ltv"] == 1200.0
    assert money["expected_loss_if_churn"] == 600.0
    assert money["proactive_intervention_cost"] == 150.0
    assert money["projected_net_benefit_usd"] == 630.0
    assert rows[1]["financial_evaluation"]["projected_net_benefit_usd"] == 0.0
    assert [r["recommended_action"] for r in rows] == [ACTIONS["HIGH"], ACTIONS["LOW"]]
    assert rows[0]["predicted_churn"] and rows[0]["model_version"] == "0.1.0"


def test_saved_money_is_never_negative(spark):
    df = scored_at(spark, [0.9], 0.35).withColumn("monthly_recurring_revenue", F.lit(1.0))
    assert df.select(financial_evaluation().alias("m")).first()["m"][
        "projected_net_benefit_usd"] == 0.0


def test_portfolio_adds_up(mart):
    scored = score_accounts(mart, rule_probability())
    tiers = portfolio_by_tier(scored).collect()
    total = portfolio_summary(scored).first()
    assert sum(r["n_accounts"] for r in tiers) == total["total_scored"] == mart.count()
    high = sum(r["n_accounts"] for r in tiers if r["risk_level"] in ("HIGH", "CRITICAL"))
    assert high == total["high_risk_count"]


def test_ranks_with_ties(spark):
    df = scored_at(spark, [0.9, 0.9, 0.8, 0.75], 0.35)
    rows = sorted(ranked_within(df, "risk_level").collect(), key=lambda r: r["customer_id"])
    assert [r["risk_rank"] for r in rows] == [1, 1, 3, 4]
    assert [r["dense_risk_rank"] for r in rows] == [1, 1, 2, 3]


def test_priority_bands(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 5, 8, 9)], "loss double")
    bands = df.select(priority_band(F.col("loss"), [5.0, 8.0, 9.0])).collect()
    assert [b[0] for b in bands] == ["P4", "P3", "P2", "P1"]
