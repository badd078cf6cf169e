"""Sources, sinks, projections, predicates and data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountrisk.functions.contract import (
    require_rows,
    split_by_contract,
    violation_summary,
    with_default_id,
    with_violations,
)
from accountrisk.functions.ratios import with_ratios
from accountrisk.functions.scoring import high_risk, rule_probability, score_accounts
from accountrisk.plans.catalog import query
from accountrisk.plans.sql import MART_CTE, SCORED_CTE
from accountrisk.schema import (
    ACCOUNT_SCHEMA,
    CATEGORICAL_FEATURES,
    NUMERIC_FEATURES,
    RATIO_INPUTS,
)
from accountrisk.session import new_path, written
from accountrisk.sources.accounts import read_accounts, write_accounts
from accountrisk.sources.mart import SERVED_CATEGORIES, account_mart, table

ALL_COLUMNS = ", ".join(ACCOUNT_SCHEMA.names)
MART_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.LongType() if f.name == "customer_id" else f.dataType)
        for f in ACCOUNT_SCHEMA.fields
    ]
)


def scored_mart(spark: SparkSession, folder: str) -> DataFrame:
    return score_accounts(account_mart(spark, folder), rule_probability())


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


#: The contract of a company that serves some segments and regions, checked on the accounts that the tables hold.
CHECKED = f""", checked AS (
  SELECT *, [x FOR x IN [
    CASE WHEN industry IS NULL THEN 'industry:missing' END,
    CASE WHEN industry NOT IN ({listed(SERVED_CATEGORIES["industry"])}) THEN 'industry:enum' END,
    CASE WHEN payment_method IS NULL THEN 'payment_method:missing' END,
    CASE WHEN payment_method NOT IN ({listed(SERVED_CATEGORIES["payment_method"])}) THEN 'payment_method:enum' END,
    CASE WHEN contract_duration_months < 1 OR contract_duration_months > 120
      THEN 'contract_duration_months:range' END,
    CASE WHEN contracted_seats < 1 THEN 'contracted_seats:range' END,
    CASE WHEN storage_usage_pct < 0 OR storage_usage_pct > 100 THEN 'storage_usage_pct:range' END,
    CASE WHEN nps_score < 0 OR nps_score > 10 THEN 'nps_score:range' END
  ] IF x IS NOT NULL] AS violations
  FROM mart
)"""


@query("q_join_account_mart", MART_CTE + f" SELECT {ALL_COLUMNS} FROM mart")
def join_account_mart(spark, folder):
    return account_mart(spark, folder)


@query("q_src_csv", MART_CTE + f" SELECT {ALL_COLUMNS} FROM mart")
def src_csv(spark, folder):
    path = write_accounts(account_mart(spark, folder), new_path(spark, "accounts") + ".csv")
    return read_accounts(spark, path, MART_SCHEMA).select(*MART_SCHEMA.names)


@query("q_src_parquet", MART_CTE + f" SELECT {ALL_COLUMNS} FROM mart")
def src_parquet(spark, folder):
    """An account batch in Parquet, read by the declared schema."""
    path = write_accounts(account_mart(spark, folder), new_path(spark, "accounts") + ".parquet")
    return read_accounts(spark, path, MART_SCHEMA)


SCORED_COLUMNS = ["customer_id", "churn_probability", "churn_prediction", "risk_level"]


@query("q_sink_csv", SCORED_CTE + f" SELECT {', '.join(SCORED_COLUMNS)} FROM scored")
def sink_csv(spark, folder):
    scored = scored_mart(spark, folder).select(*SCORED_COLUMNS)
    path = write_accounts(scored, new_path(spark, "scored") + ".csv")
    return read_accounts(spark, path, scored.schema).select(*SCORED_COLUMNS)


@query("q_sink_parquet", SCORED_CTE + f" SELECT {', '.join(SCORED_COLUMNS)} FROM scored")
def sink_parquet(spark, folder):
    scored = scored_mart(spark, folder).select(*SCORED_COLUMNS)
    path = write_accounts(scored, new_path(spark, "scored") + ".parquet")
    return read_accounts(spark, path, scored.schema)


@query(
    "q_proj_features",
    MART_CTE + " SELECT * EXCLUDE (customer_id, churn) FROM mart",
)
def proj_features(spark, folder):
    return account_mart(spark, folder).drop("churn", "customer_id", "no_such_column")


@query(
    "q_proj_select_remainder_drop",
    MART_CTE + f" SELECT {', '.join(NUMERIC_FEATURES + CATEGORICAL_FEATURES)} FROM mart",
)
def proj_select_remainder_drop(spark, folder):
    return account_mart(spark, folder).select(*NUMERIC_FEATURES, *CATEGORICAL_FEATURES)


RATIO_SQL = """
    least(greatest(active_users_last_30d::DOUBLE, 0e0) / greatest(contracted_seats::DOUBLE, 1e0),
      1.5e0) AS seat_utilization_rate,
    least(unresolved_tickets_count::DOUBLE / (support_tickets_count::DOUBLE + 1e-5), 1e0)
      AS unresolved_tickets_ratio,
    avg_daily_logins / (active_users_last_30d::DOUBLE + 1e-5) AS avg_logins_per_active_user,
    monthly_recurring_revenue / greatest(contracted_seats::DOUBLE, 1e0)
      AS mrr_per_contracted_seat"""


@query(
    "q_proj_drop_intermediates",
    MART_CTE
    + f", r AS (SELECT *, {RATIO_SQL} FROM mart)"
    + f" SELECT * EXCLUDE ({', '.join(RATIO_INPUTS)}) FROM r",
)
def proj_drop_intermediates(spark, folder):
    return with_ratios(account_mart(spark, folder), drop_intermediates=True)


@query(
    "q_dq_contract_gate",
    MART_CTE
    + CHECKED
    + " SELECT customer_id, array_to_string(list_sort(violations), ',') AS violations,"
    + " len(violations) = 0 AS is_valid FROM checked",
)
def dq_contract_gate(spark, folder):
    checked = with_violations(account_mart(spark, folder), SERVED_CATEGORIES)
    return checked.select(
        "customer_id",
        F.array_join(F.array_sort("violations"), ",").alias("violations"),
        (F.size("violations") == 0).alias("is_valid"),
    )


@query(
    "q_dq_violation_summary",
    MART_CTE
    + CHECKED
    + " SELECT code, count(*)::BIGINT AS n_rows FROM (SELECT unnest(violations) AS code"
    + " FROM checked) GROUP BY code",
)
def dq_violation_summary(spark, folder):
    return violation_summary(
        with_violations(account_mart(spark, folder), SERVED_CATEGORIES)
    )


@query(
    "q_dq_empty_batch",
    MART_CTE
    + " SELECT r_name AS region, count(customer_id)::BIGINT AS n_accounts, count(customer_id) > 0 AS is_accepted"
    + " FROM region LEFT JOIN mart ON payment_method = r_name AND plan_tier = 'Enterprise'"
    + " AND billing_cycle = 'Multi-Year' AND industry = 'BUILDING' GROUP BY r_name",
)
def dq_empty_batch(spark, folder):
    """A batch per region offered to the gate that refuses empty ones."""
    mart = account_mart(spark, folder).where("plan_tier = 'Enterprise' AND billing_cycle = 'Multi-Year'")
    offers = written(mart.where("industry = 'BUILDING'").select("customer_id", "payment_method"), "offers")
    counts = {r[0]: r[1] for r in offers.groupBy("payment_method").count().collect()}  # one row per region
    rows = []
    for (region,) in table(spark, folder, "region").select("r_name").collect():
        try:
            require_rows(offers.where(F.col("payment_method") == region))
            rows.append((region, counts[region], True))
        except ValueError:
            rows.append((region, 0, False))
    return spark.createDataFrame(rows, "region string, n_accounts bigint, is_accepted boolean")


@query(
    "q_dq_default_id",
    MART_CTE
    + " SELECT coalesce(CASE WHEN invoice_delay_days = 0 THEN customer_id::VARCHAR END,"
    + " 'CUST-ONLINE-001') AS customer_id, plan_tier, contracted_seats FROM mart",
)
def dq_default_id(spark, folder):
    mart = account_mart(spark, folder)
    anonymous = mart.withColumn(
        "customer_id", F.when(F.col("invoice_delay_days") == 0, F.col("customer_id"))
    )
    return with_default_id(anonymous).select("customer_id", "plan_tier", "contracted_seats")


@query(
    "q_join_quarantine_anti",
    MART_CTE + CHECKED + " SELECT customer_id, plan_tier, nps_score FROM mart f WHERE NOT EXISTS"
    " (SELECT 1 FROM checked c WHERE len(c.violations) > 0 AND c.customer_id = f.customer_id)",
)
def join_quarantine_anti(spark, folder):
    """Accounts without those that sit in quarantine."""
    feed = written(account_mart(spark, folder), "feed")
    _, rejected = split_by_contract(feed, SERVED_CATEGORIES)
    return feed.join(rejected.select("customer_id"), "customer_id", "left_anti").select(
        "customer_id", "plan_tier", "nps_score"
    )


@query("q_flt_threshold", SCORED_CTE + " SELECT customer_id, churn_prediction FROM scored")
def flt_threshold(spark, folder):
    return scored_mart(spark, folder).select("customer_id", "churn_prediction")


@query(
    "q_flt_dropna",
    MART_CTE
    + " SELECT feature, count(*)::BIGINT AS n_values FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature FROM mart WHERE {c} IS NOT NULL" for c in NUMERIC_FEATURES
    )
    + ") GROUP BY feature",
)
def flt_dropna(spark, folder):
    mart = account_mart(spark, folder)
    long = mart.select(*[F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES]).unpivot(
        [], NUMERIC_FEATURES, "feature", "value"
    )
    return (
        long.where(F.col("value").isNotNull())
        .groupBy("feature")
        .agg(F.count("*").alias("n_values"))
    )


@query(
    "q_flt_high_risk",
    SCORED_CTE
    + " SELECT customer_id, churn_probability, risk_level FROM scored"
    + " WHERE risk_level IN ('HIGH', 'CRITICAL')",
)
def flt_high_risk(spark, folder):
    return (
        scored_mart(spark, folder)
        .where(high_risk())
        .select("customer_id", "churn_probability", "risk_level")
    )


@query(
    "q_profile_nulls",
    MART_CTE
    + " SELECT count(*)::BIGINT AS n_rows, "
    + ", ".join(
        f"(count(*) FILTER (WHERE {c} IS NULL))::BIGINT AS {c}_nulls" for c in NUMERIC_FEATURES
    )
    + " FROM mart",
)
def profile_nulls(spark, folder):
    return account_mart(spark, folder).agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in NUMERIC_FEATURES],
    )


@query(
    "q_profile_label_rate",
    MART_CTE
    + " SELECT count(*)::BIGINT AS n_rows, sum(churn)::BIGINT AS n_churned,"
    + " round_even(avg(churn), 6) AS churn_rate FROM mart",
)
def profile_label_rate(spark, folder):
    return account_mart(spark, folder).agg(
        F.count("*").alias("n_rows"),
        F.sum("churn").alias("n_churned"),
        F.bround(F.avg("churn"), 6).alias("churn_rate"),
    )
