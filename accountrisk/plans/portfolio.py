"""Scored accounts: tiers, money, priorities, rankings and portfolio aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountrisk.functions.contract import split_by_contract
from accountrisk.functions.scoring import (
    financial_evaluation,
    log_odds,
    priority_band,
    recommended_action,
    response,
    rule_probability,
    score_accounts,
    top_factors,
)
from accountrisk.operators.portfolio import (
    portfolio_by_tier,
    portfolio_rollup,
    portfolio_summary,
    ranked_within,
)
from accountrisk.operators.quantiles import exact_quantiles
from accountrisk.plans.catalog import query
from accountrisk.plans.intake import scored_mart
from accountrisk.plans.sql import MART_CTE, SCORED_CTE
from accountrisk.schema import DEFAULT_THRESHOLD
from accountrisk.session import written
from accountrisk.sources.mart import MART_CATEGORIES, account_mart


def gated_scores(spark, folder) -> DataFrame:
    """Accounts that keep the contract, scored by the rule scorecard."""
    valid, _ = split_by_contract(account_mart(spark, folder), MART_CATEGORIES)
    return score_accounts(valid, rule_probability())


GATED_CTE = SCORED_CTE + ", gated AS (SELECT * FROM scored WHERE contracted_seats >= 1)"


@query(
    "q_score_rule_log_odds",
    MART_CTE
    + SCORED_CTE.removeprefix(MART_CTE)
    + " SELECT customer_id, round_even(log_odds, 6) AS log_odds, round_even(p, 6) AS probability"
    + " FROM scored",
)
def score_rule_log_odds(spark, folder):
    return account_mart(spark, folder).select(
        "customer_id",
        F.bround(log_odds(), 6).alias("log_odds"),
        F.bround(rule_probability(), 6).alias("probability"),
    )


FACTORS_SQL = {
    "low_seat_utilization": "(1e0 - active_users_last_30d::DOUBLE"
    " / greatest(contracted_seats::DOUBLE, 1e0)) * 2.2e0",
    "payment_delay": "invoice_delay_days / 15e0 * 1.5e0",
    "unresolved_tickets": "(unresolved_tickets_count::DOUBLE"
    " / (support_tickets_count::DOUBLE + 1e0)) * 2e0",
    "monthly_billing": "CASE WHEN billing_cycle = 'Monthly' THEN 0.6e0 ELSE -0.4e0 END",
    "no_auto_renew": "CASE WHEN NOT auto_renew_enabled THEN 0.8e0 ELSE -0.3e0 END",
    "detractor_nps": "CASE WHEN nps_score <= 5e0 THEN 1.4e0 ELSE -0.5e0 END",
    "low_feature_adoption": "CASE WHEN feature_adoption_score < 40e0 THEN 1.2e0 ELSE -0.4e0 END",
    "enterprise_plan": "CASE WHEN plan_tier = 'Enterprise' THEN -0.7e0 ELSE 0.1e0 END",
    "tenure": "-(contract_duration_months::DOUBLE / 36e0)",
}


@query(
    "q_score_top_factors",
    MART_CTE
    + ", f AS ("
    + " UNION ALL ".join(
        f"SELECT customer_id, '{n}' AS factor, {e} AS contribution FROM mart"
        for n, e in FACTORS_SQL.items()
    )
    + ") SELECT customer_id, factor_rank, factor, round_even(contribution, 6) AS contribution FROM ("
    + "SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY contribution DESC, factor)"
    + "::INTEGER AS factor_rank FROM f) WHERE factor_rank <= 3",
)
def score_top_factors(spark, folder):
    exploded = account_mart(spark, folder).select(
        "customer_id", F.posexplode(top_factors()).alias("position", "entry")
    )
    return exploded.select(
        "customer_id",
        (F.col("position") + 1).alias("factor_rank"),
        F.col("entry.factor").alias("factor"),
        F.bround("entry.contribution", 6).alias("contribution"),
    )


@query("q_score_batch", SCORED_CTE + " SELECT * EXCLUDE (log_odds, p) FROM scored")
def score_batch(spark, folder):
    return scored_mart(spark, folder)


@query(
    "q_score_risk_tier",
    SCORED_CTE + " SELECT customer_id, churn_probability, risk_level FROM scored",
)
def score_risk_tier(spark, folder):
    return scored_mart(spark, folder).select("customer_id", "churn_probability", "risk_level")


ACTION_SQL = """CASE risk_level
    WHEN 'LOW' THEN 'Maintain standard communication (Routine Nurturing)'
    WHEN 'MEDIUM' THEN 'Monitor product adoption and feature usage metrics'
    WHEN 'HIGH' THEN 'Trigger proactive Customer Success outreach and alignment call'
    ELSE 'Immediate executive escalation / Plan renegotiation or custom discount' END"""


@query(
    "q_score_action",
    SCORED_CTE + f" SELECT customer_id, {ACTION_SQL} AS recommended_action FROM scored",
)
def score_action(spark, folder):
    return scored_mart(spark, folder).select(
        "customer_id",
        recommended_action(F.col("churn_probability"), DEFAULT_THRESHOLD).alias(
            "recommended_action"
        ),
    )


MONEY_SQL = """round_even(monthly_recurring_revenue, 2) AS monthly_recurring_revenue,
    round_even(monthly_recurring_revenue * 12e0, 2) AS estimated_annual_ltv,
    round_even(churn_probability * (monthly_recurring_revenue * 12e0), 2) AS expected_loss_if_churn,
    CASE WHEN churn_prediction = 1 THEN 150e0 ELSE 0e0 END AS proactive_intervention_cost,
    CASE WHEN churn_prediction = 1 THEN round_even(greatest(0e0,
      0.65e0 * (monthly_recurring_revenue * 12e0) - 150e0), 2) ELSE 0e0 END
      AS projected_net_benefit_usd"""


@query("q_score_financial", SCORED_CTE + f" SELECT customer_id, {MONEY_SQL} FROM scored")
def score_financial(spark, folder):
    money = scored_mart(spark, folder).select("customer_id", financial_evaluation().alias("money"))
    return money.select("customer_id", "money.*")


@query(
    "q_score_response",
    SCORED_CTE
    + " SELECT customer_id::VARCHAR AS customer_id, churn_probability,"
    + " churn_prediction = 1 AS predicted_churn, decision_threshold AS decision_threshold_used,"
    + f" risk_level, {ACTION_SQL} AS recommended_action, {MONEY_SQL}, '0.1.0' AS model_version"
    + " FROM scored",
)
def score_response(spark, folder):
    """The nested response with its money struct spread into columns."""
    return response(scored_mart(spark, folder)).select("*", "financial_evaluation.*").drop(
        "financial_evaluation"
    )


PRIORITY_PROBS = [0.5, 0.8, 0.95]


@query(
    "q_score_priority",
    SCORED_CTE
    + """, losses AS (
  SELECT customer_id,
    round_even(churn_probability * (monthly_recurring_revenue * 12e0), 2) AS expected_loss
  FROM scored
), cuts AS (
  SELECT quantile_cont(expected_loss, 0.5) AS c1, quantile_cont(expected_loss, 0.8) AS c2,
    quantile_cont(expected_loss, 0.95) AS c3 FROM losses
)
SELECT customer_id, expected_loss, CASE WHEN expected_loss >= c3 THEN 'P1'
  WHEN expected_loss >= c2 THEN 'P2' WHEN expected_loss >= c1 THEN 'P3' ELSE 'P4' END AS priority
FROM losses, cuts""",
)
def score_priority(spark, folder):
    losses = written(
        scored_mart(spark, folder).select(
            "customer_id", financial_evaluation()["expected_loss_if_churn"].alias("expected_loss")
        ),
        "losses",
    )
    cuts = exact_quantiles(losses, ["expected_loss"], PRIORITY_PROBS)["expected_loss"]
    return losses.withColumn("priority", priority_band(F.col("expected_loss"), cuts))


@query(
    "q_agg_portfolio_summary",
    SCORED_CTE
    + " SELECT count(*)::BIGINT AS total_scored,"
    + " (count(*) FILTER (WHERE risk_level IN ('HIGH', 'CRITICAL')))::BIGINT AS high_risk_count,"
    + " round_even(coalesce(sum(monthly_recurring_revenue) FILTER (WHERE churn_prediction = 1),"
    + " 0e0), 2) AS total_mrr_at_risk_usd FROM scored",
)
def agg_portfolio_summary(spark, folder):
    return portfolio_summary(scored_mart(spark, folder))


TIER_AGGS_SQL = """count(*)::BIGINT AS n_accounts, sum(churn_prediction)::BIGINT AS n_predicted,
    round_even(sum(monthly_recurring_revenue), 2) AS total_mrr,
    round_even(coalesce(sum(monthly_recurring_revenue) FILTER (WHERE churn_prediction = 1), 0e0), 2)
      AS mrr_at_risk,
    round_even(sum(round_even(churn_probability * (monthly_recurring_revenue * 12e0), 2)), 2)
      AS expected_loss"""


@query(
    "q_agg_portfolio_by_tier",
    GATED_CTE + f" SELECT risk_level, {TIER_AGGS_SQL} FROM gated GROUP BY risk_level",
)
def agg_portfolio_by_tier(spark, folder):
    return portfolio_by_tier(gated_scores(spark, folder))


@query(
    "q_agg_portfolio_rollup",
    GATED_CTE
    + f" SELECT industry, risk_level, {TIER_AGGS_SQL} FROM gated"
    + " GROUP BY ROLLUP (industry, risk_level)",
)
def agg_portfolio_rollup(spark, folder):
    return portfolio_rollup(gated_scores(spark, folder))


@query(
    "q_sort_by_risk",
    SCORED_CTE
    + " SELECT customer_id, churn_probability, risk_level FROM scored"
    + " ORDER BY churn_probability DESC, customer_id",
)
def sort_by_risk(spark, folder):
    return (
        scored_mart(spark, folder)
        .select("customer_id", "churn_probability", "risk_level")
        .orderBy(F.desc("churn_probability"), "customer_id")
    )


@query(
    "q_sort_by_financial_risk",
    SCORED_CTE
    + " SELECT customer_id, round_even(churn_probability * (monthly_recurring_revenue * 12e0), 2)"
    + " AS expected_loss FROM scored ORDER BY expected_loss DESC, customer_id",
)
def sort_by_financial_risk(spark, folder):
    return (
        scored_mart(spark, folder)
        .select(
            "customer_id", financial_evaluation()["expected_loss_if_churn"].alias("expected_loss")
        )
        .orderBy(F.desc("expected_loss"), "customer_id")
    )


@query(
    "q_topk_accounts",
    SCORED_CTE
    + " SELECT customer_id, churn_probability FROM scored"
    + " ORDER BY churn_probability DESC, customer_id LIMIT 25",
)
def topk_accounts(spark, folder):
    return sort_by_risk(spark, folder).select("customer_id", "churn_probability").limit(25)


@query(
    "q_win_risk_rank",
    SCORED_CTE
    + " SELECT customer_id, risk_level, churn_probability,"
    + " rank() OVER (PARTITION BY risk_level ORDER BY churn_probability DESC)::BIGINT AS risk_rank,"
    + " dense_rank() OVER (PARTITION BY risk_level ORDER BY churn_probability DESC)::BIGINT"
    + " AS dense_risk_rank FROM scored",
)
def win_risk_rank(spark, folder):
    scored = written(
        scored_mart(spark, folder).select("customer_id", "risk_level", "churn_probability"),
        "scored",
    )
    return ranked_within(scored, "risk_level")
