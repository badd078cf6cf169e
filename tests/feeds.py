"""Batches with known faults and shifts, for tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def raw_feed(mart: DataFrame) -> DataFrame:
    """The mart as a careless sender might deliver it: values outside the contract, a retired plan."""
    return mart.withColumns(
        {
            "nps_score": F.col("nps_score") - 3.0,
            "storage_usage_pct": F.col("storage_usage_pct") * 2.0,
            "plan_tier": F.when(
                (F.col("plan_tier") == "Starter") & (F.col("contracted_seats") < 500), "Free-Trial"
            ).otherwise(F.col("plan_tier")),
            "billing_cycle": F.when(F.col("billing_cycle") != "Multi-Year", F.col("billing_cycle")),
            "invoice_delay_days": F.col("invoice_delay_days") - 20.0,
        }
    )


def shifted_batch(df: DataFrame, mrr_factor: float = 1.0, plan: str | None = None) -> DataFrame:
    """Surveys three points lower, delays 2.2 times as long, five more tickets; on demand other revenue and plans."""
    moved = F.least(F.greatest(F.col("nps_score") - 3.0, F.lit(0.0)), F.lit(10.0))
    changes = {
        "nps_score": F.when(F.col("nps_score").isNotNull(), moved),
        "invoice_delay_days": F.col("invoice_delay_days") * 2.2,
        "support_tickets_count": F.col("support_tickets_count") + 5,
        "monthly_recurring_revenue": F.col("monthly_recurring_revenue") * mrr_factor,
    }
    if plan is not None:
        changes["plan_tier"] = F.lit(plan)
    return df.withColumns(changes)
