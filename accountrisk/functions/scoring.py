"""Rule scorecard, tiers, actions and money columns for scored accounts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountrisk.functions.numeric import at_least, number, rounded
from accountrisk.schema import DEFAULT_THRESHOLD, BusinessTerms

# Tier cut points and action texts.
LOW_CUT = 0.20
CRITICAL_CUT = 0.70
ACTIONS = {
    "LOW": "Maintain standard communication (Routine Nurturing)",
    "MEDIUM": "Monitor product adoption and feature usage metrics",
    "HIGH": "Trigger proactive Customer Success outreach and alignment call",
    "CRITICAL": "Immediate executive escalation / Plan renegotiation or custom discount",
}

# Fixed value: intercept of the scorecard.
BASE_LOG_ODDS = -2.8


def log_odds_factors() -> dict[str, Column]:
    """Additive log-odds contribution of each risk factor; a missing NPS is not a detractor."""
    utilization = number("active_users_last_30d") / at_least(number("contracted_seats"), 1.0)
    open_share = number("unresolved_tickets_count") / (number("support_tickets_count") + 1.0)

    def either(condition: Column, yes: float, no: float) -> Column:
        return F.when(condition, F.lit(yes)).otherwise(F.lit(no))

    return {
        "low_seat_utilization": (F.lit(1.0) - utilization) * 2.2,
        "payment_delay": number("invoice_delay_days") / 15.0 * 1.5,
        "unresolved_tickets": open_share * 2.0,
        "monthly_billing": either(F.col("billing_cycle") == "Monthly", 0.6, -0.4),
        "no_auto_renew": either(~F.col("auto_renew_enabled"), 0.8, -0.3),
        "detractor_nps": either(F.col("nps_score") <= 5.0, 1.4, -0.5),
        "low_feature_adoption": either(F.col("feature_adoption_score") < 40.0, 1.2, -0.4),
        "enterprise_plan": either(F.col("plan_tier") == "Enterprise", -0.7, 0.1),
        "tenure": -(number("contract_duration_months") / 36.0),
    }


def log_odds() -> Column:
    return reduce(lambda a, b: a + b, log_odds_factors().values(), F.lit(BASE_LOG_ODDS))


def rule_probability() -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds()))


def top_factors(count: int = 3) -> Column:
    """Largest contributions first, as an array of (factor, contribution) structs."""
    entries = F.array(
        *[
            F.struct((-value).alias("order"), F.lit(name).alias("factor"))
            for name, value in log_odds_factors().items()
        ]
    )
    return F.transform(
        F.slice(F.array_sort(entries), 1, count),
        lambda e: F.struct(e["factor"].alias("factor"), (-e["order"]).alias("contribution")),
    )


def predicted(probability: Column, threshold: float) -> Column:
    return (probability >= F.lit(threshold)).cast("int")


def risk_tier(probability: Column, threshold: float) -> Column:
    """First matching cut wins, so a threshold below the low cut leaves MEDIUM empty."""
    return (
        F.when(probability < LOW_CUT, "LOW")
        .when(probability < threshold, "MEDIUM")
        .when(probability < CRITICAL_CUT, "HIGH")
        .when(probability.isNotNull(), "CRITICAL")
    )


def recommended_action(probability: Column, threshold: float) -> Column:
    return (
        F.when(probability < LOW_CUT, ACTIONS["LOW"])
        .when(probability < threshold, ACTIONS["MEDIUM"])
        .when(probability < CRITICAL_CUT, ACTIONS["HIGH"])
        .when(probability.isNotNull(), ACTIONS["CRITICAL"])
    )


def score_accounts(
    df: DataFrame,
    probability: Column,
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """All input columns plus probability, prediction, threshold and tier.

    The prediction looks at the unrounded probability, the tier at the one rounded to four places.
    """
    return (
        df.withColumn("__p", probability)
        .withColumns(
            {
                "churn_probability": rounded(F.col("__p"), 4),
                "churn_prediction": predicted(F.col("__p"), threshold),
                "decision_threshold": F.lit(round(threshold, 4)),
            }
        )
        .drop("__p")
        .withColumn("risk_level", risk_tier(F.col("churn_probability"), threshold))
    )


def financial_evaluation(terms: BusinessTerms = BusinessTerms()) -> Column:
    """Money struct of a scored account."""
    mrr = F.col("monthly_recurring_revenue")
    ltv = mrr * F.lit(terms.ltv_multiplier)
    flagged = F.col("churn_prediction") == 1
    saved = F.greatest(
        F.lit(0.0), F.lit(terms.success_rate) * ltv - F.lit(terms.intervention_cost)
    )
    return F.struct(
        rounded(mrr, 2).alias("monthly_recurring_revenue"),
        rounded(ltv, 2).alias("estimated_annual_ltv"),
        rounded(F.col("churn_probability") * ltv, 2).alias("expected_loss_if_churn"),
        F.when(flagged, F.lit(terms.intervention_cost))
        .otherwise(F.lit(0.0))
        .alias("proactive_intervention_cost"),
        F.when(flagged, rounded(saved, 2))
        .otherwise(F.lit(0.0))
        .alias("projected_net_benefit_usd"),
    )


def response(
    scored: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    model_version: str = "0.1.0",
    terms: BusinessTerms = BusinessTerms(),
) -> DataFrame:
    """Response rows: flat decision fields, nested money struct and the model version."""
    return scored.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        "churn_probability",
        (F.col("churn_prediction") == 1).alias("predicted_churn"),
        F.col("decision_threshold").alias("decision_threshold_used"),
        "risk_level",
        recommended_action(F.col("churn_probability"), threshold).alias("recommended_action"),
        financial_evaluation(terms).alias("financial_evaluation"),
        F.lit(model_version).alias("model_version"),
    )


def high_risk() -> Column:
    return F.col("risk_level").isin("HIGH", "CRITICAL")


def priority_band(loss: Column, cuts: Sequence[float | None]) -> Column:
    """Intervention priority P1..P4 from ascending expected-loss cut points."""
    band = F.lit("P4")
    for rank, cut in enumerate(cuts):
        band = F.when(loss >= F.lit(cut), f"P{len(cuts) - rank}").otherwise(band)
    return band
