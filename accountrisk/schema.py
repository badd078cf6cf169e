"""Account table: schema, feature roles and business settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

ID_COLUMN = "customer_id"
TARGET_COLUMN = "churn"

ACCOUNT_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("industry", T.StringType()),
        T.StructField("company_size_bracket", T.StringType()),
        T.StructField("plan_tier", T.StringType()),
        T.StructField("billing_cycle", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("auto_renew_enabled", T.BooleanType()),
        T.StructField("contract_duration_months", T.IntegerType()),
        T.StructField("contracted_seats", T.LongType()),
        T.StructField("active_users_last_30d", T.LongType()),
        T.StructField("monthly_recurring_revenue", T.DoubleType()),
        T.StructField("avg_daily_logins", T.DoubleType()),
        T.StructField("feature_adoption_score", T.DoubleType()),
        T.StructField("storage_usage_pct", T.DoubleType()),
        T.StructField("support_tickets_count", T.LongType()),
        T.StructField("unresolved_tickets_count", T.LongType()),
        T.StructField("nps_score", T.DoubleType()),
        T.StructField("invoice_delay_days", T.DoubleType()),
        T.StructField("churn", T.IntegerType()),
    ]
)

NUMERIC_FEATURES = [
    "monthly_recurring_revenue",
    "contract_duration_months",
    "contracted_seats",
    "active_users_last_30d",
    "avg_daily_logins",
    "feature_adoption_score",
    "support_tickets_count",
    "unresolved_tickets_count",
    "nps_score",
    "invoice_delay_days",
    "storage_usage_pct",
]

CATEGORICAL_FEATURES = [
    "plan_tier",
    "industry",
    "company_size_bracket",
    "billing_cycle",
    "payment_method",
    "auto_renew_enabled",
]

RATIO_FEATURES = [
    "seat_utilization_rate",
    "unresolved_tickets_ratio",
    "avg_logins_per_active_user",
    "mrr_per_contracted_seat",
]

RATIO_INPUTS = [
    "contracted_seats",
    "active_users_last_30d",
    "support_tickets_count",
    "unresolved_tickets_count",
    "avg_daily_logins",
    "monthly_recurring_revenue",
]


@dataclass(frozen=True)
class BusinessTerms:
    """Economics of a retention campaign."""

    intervention_cost: float = 150.0
    success_rate: float = 0.65
    ltv_multiplier: float = 12.0
    default_mrr: float = 850.0


# Allowed categories of the data contract.
CONTRACT_CATEGORIES = {
    "industry": ["FinTech", "HealthTech", "E-commerce", "EdTech", "Enterprise SaaS", "Logistics"],
    "company_size_bracket": ["1-10", "11-50", "51-200", "201-1000", "1000+"],
    "plan_tier": ["Starter", "Professional", "Enterprise"],
    "billing_cycle": ["Monthly", "Annual", "Multi-Year"],
    "payment_method": ["Credit_Card", "Bank_Transfer", "ACH"],
}

# Inclusive (lower, upper) limits of the data contract; None is unbounded.
CONTRACT_RANGES = {
    "contract_duration_months": (1, 120),
    "contracted_seats": (1, None),
    "active_users_last_30d": (0, None),
    "monthly_recurring_revenue": (0, None),
    "avg_daily_logins": (0, None),
    "feature_adoption_score": (0, 100),
    "storage_usage_pct": (0, 100),
    "support_tickets_count": (0, None),
    "unresolved_tickets_count": (0, None),
    "nps_score": (0, 10),
    "invoice_delay_days": (0, None),
}

# Fields that may be missing.
CONTRACT_NULLABLE = ["storage_usage_pct", "nps_score"]

# Identifiers given to records that arrive without one.
DEFAULT_CUSTOMER_ID = "CUST-ONLINE-001"

DEFAULT_THRESHOLD = 0.35
