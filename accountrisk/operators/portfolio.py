"""Aggregates and rankings over scored accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountrisk.functions.numeric import rounded
from accountrisk.functions.scoring import financial_evaluation, high_risk
from accountrisk.schema import BusinessTerms


def _mrr_at_risk() -> Column:
    at_risk = F.when(F.col("churn_prediction") == 1, F.col("monthly_recurring_revenue"))
    return rounded(F.coalesce(F.sum(at_risk), F.lit(0.0)), 2)


def portfolio_summary(scored: DataFrame) -> DataFrame:
    """One row: accounts scored, accounts at high risk, revenue predicted to churn."""
    return scored.agg(
        F.count("*").alias("total_scored"),
        F.count_if(high_risk()).alias("high_risk_count"),
        _mrr_at_risk().alias("total_mrr_at_risk_usd"),
    )


def _tier_aggregates(terms: BusinessTerms) -> list[Column]:
    loss = financial_evaluation(terms)["expected_loss_if_churn"]
    return [
        F.count("*").alias("n_accounts"),
        F.sum("churn_prediction").alias("n_predicted"),
        rounded(F.sum("monthly_recurring_revenue"), 2).alias("total_mrr"),
        _mrr_at_risk().alias("mrr_at_risk"),
        rounded(F.sum(loss), 2).alias("expected_loss"),
    ]


def portfolio_by_tier(scored: DataFrame, terms: BusinessTerms = BusinessTerms()) -> DataFrame:
    return scored.groupBy("risk_level").agg(*_tier_aggregates(terms))


def portfolio_rollup(scored: DataFrame, terms: BusinessTerms = BusinessTerms()) -> DataFrame:
    """Industry by tier with subtotals and the grand total."""
    return scored.rollup("industry", "risk_level").agg(*_tier_aggregates(terms))


def ranked_within(scored: DataFrame, group: str) -> DataFrame:
    """Rank and dense rank by falling probability inside each group.

    Probabilities carry four decimals, so a group has at most 10,001 distinct ones: ranks are computed
    on that table and joined back, which keeps a tier with a third of all accounts
    out of a single window partition.
    """
    steps = scored.groupBy(group, "churn_probability").agg(F.count("*").alias("n"))
    falling = Window.partitionBy(group).orderBy(F.desc("churn_probability"))
    ranks = steps.select(
        group,
        "churn_probability",
        (
            F.coalesce(
                F.sum("n").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            )
            + 1
        ).alias("risk_rank"),
        F.row_number().over(falling).cast("bigint").alias("dense_risk_rank"),
    )
    return scored.join(ranks, [group, "churn_probability"], "left")
