"""Shared SQL fragments for the DuckDB side of each query."""

from __future__ import annotations

from accountrisk.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from accountrisk.sources.mart import EARLIER_SNAPSHOT, SNAPSHOT

def mart_ctes(snapshot: str = SNAPSHOT, name: str = "mart") -> str:
    """CTEs that end in the account table ``name`` of a snapshot."""
    return f"""{name}_orders AS (
  SELECT o_custkey,
    count(*) FILTER (WHERE o_orderdate < TIMESTAMP '{snapshot}') AS n_orders,
    count(*) FILTER (WHERE o_orderdate < TIMESTAMP '{snapshot}'
      AND o_orderpriority IN ('1-URGENT', '2-HIGH')) AS n_urgent,
    min(o_orderdate) FILTER (WHERE o_orderdate < TIMESTAMP '{snapshot}') AS first_order,
    count(*) FILTER (WHERE o_orderdate < TIMESTAMP '{snapshot}'
      AND o_orderdate >= TIMESTAMP '{snapshot}' - INTERVAL 6 MONTH) AS n_recent,
    count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{snapshot}') AS n_future
  FROM orders GROUP BY o_custkey
), {name}_lines AS (
  SELECT o.o_custkey, l.*, p.p_brand,
    o.o_orderdate >= TIMESTAMP '{snapshot}' - INTERVAL 12 MONTH AS is_recent
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  WHERE o.o_orderdate < TIMESTAMP '{snapshot}'
), {name}_facts AS (
  SELECT o_custkey, count(*) AS n_lines,
    count(*) FILTER (WHERE is_recent) AS n_lines_recent,
    round(sum(l_quantity), 4) AS quantity,
    round(sum(l_quantity) FILTER (WHERE is_recent), 4) AS quantity_recent,
    round(sum(l_extendedprice * (1e0 - l_discount)), 4) AS revenue,
    round(sum(l_tax), 4) AS tax,
    count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
    count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'O') AS n_returned_open,
    count(*) FILTER (WHERE l_returnflag = 'R' AND is_recent) AS n_returned_recent,
    count(DISTINCT p_brand) AS n_brands
  FROM {name}_lines GROUP BY o_custkey
), {name}_joined AS (
  SELECT o.*, l.* EXCLUDE (o_custkey), c.*, r.r_name,
    greatest((year(TIMESTAMP '{snapshot}') - year(first_order)) * 12
      + month(TIMESTAMP '{snapshot}') - month(first_order), 1)::INTEGER AS months
  FROM {name}_orders o LEFT JOIN {name}_facts l USING (o_custkey)
  JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
  WHERE o.n_orders > 0
), {name} AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS industry,
    CASE WHEN n_orders <= 5 THEN '1-10' WHEN n_orders <= 7 THEN '11-50'
      WHEN n_orders <= 9 THEN '51-200' WHEN n_orders <= 12 THEN '201-1000'
      ELSE '1000+' END AS company_size_bracket,
    CASE WHEN c_acctbal < 3000 THEN 'Starter' WHEN c_acctbal < 7000 THEN 'Professional'
      ELSE 'Enterprise' END AS plan_tier,
    CASE WHEN n_urgent * 2 >= n_orders THEN 'Monthly' WHEN n_urgent * 4 >= n_orders THEN 'Annual'
      ELSE 'Multi-Year' END AS billing_cycle,
    r_name AS payment_method,
    n_recent > 0 AS auto_renew_enabled,
    months AS contract_duration_months,
    coalesce(quantity, 0e0)::BIGINT AS contracted_seats,
    coalesce(quantity_recent, 0e0)::BIGINT AS active_users_last_30d,
    coalesce(revenue, 0e0) / months AS monthly_recurring_revenue,
    coalesce(n_lines_recent, 0) / 12e0 AS avg_daily_logins,
    100e0 * coalesce(n_brands, 0) / 25e0 AS feature_adoption_score,
    1000e0 * tax / n_lines AS storage_usage_pct,
    coalesce(n_returned, 0)::BIGINT AS support_tickets_count,
    coalesce(n_returned_open, 0)::BIGINT AS unresolved_tickets_count,
    CASE WHEN n_lines_recent > 0
      THEN 10e0 * (1e0 - n_returned_recent::DOUBLE / n_lines_recent) END AS nps_score,
    CASE WHEN c_acctbal < 0 THEN -c_acctbal / 20e0 ELSE 0e0 END AS invoice_delay_days,
    (n_future = 0)::INTEGER AS churn
  FROM {name}_joined
)"""

MART_CTE = "WITH RECURSIVE " + mart_ctes()
#: Both batches of the drift audits: ``earlier`` and ``mart``.
TWO_MARTS_CTE = MART_CTE + ", " + mart_ctes(EARLIER_SNAPSHOT, "earlier")

# Rule scorecard, term by term in the order of the Spark expression.
SCORED = """, odds AS (
  SELECT *, -2.8e0
    + (1e0 - active_users_last_30d::DOUBLE / greatest(contracted_seats::DOUBLE, 1e0)) * 2.2e0
    + invoice_delay_days / 15e0 * 1.5e0
    + (unresolved_tickets_count::DOUBLE / (support_tickets_count::DOUBLE + 1e0)) * 2e0
    + CASE WHEN billing_cycle = 'Monthly' THEN 0.6e0 ELSE -0.4e0 END
    + CASE WHEN NOT auto_renew_enabled THEN 0.8e0 ELSE -0.3e0 END
    + CASE WHEN nps_score <= 5e0 THEN 1.4e0 ELSE -0.5e0 END
    + CASE WHEN feature_adoption_score < 40e0 THEN 1.2e0 ELSE -0.4e0 END
    + CASE WHEN plan_tier = 'Enterprise' THEN -0.7e0 ELSE 0.1e0 END
    + -(contract_duration_months::DOUBLE / 36e0) AS log_odds
  FROM mart
), probs AS (
  SELECT *, 1e0 / (1e0 + exp(-log_odds)) AS p FROM odds
), scored AS (
  SELECT *, CASE WHEN churn_probability < 0.2e0 THEN 'LOW'
      WHEN churn_probability < 0.35e0 THEN 'MEDIUM'
      WHEN churn_probability < 0.7e0 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level
  FROM (SELECT *, round_even(p, 4) AS churn_probability,
      (p >= 0.35e0)::INTEGER AS churn_prediction, 0.35e0 AS decision_threshold FROM probs)
)"""

SCORED_CTE = MART_CTE + SCORED

# Label, score and revenue vectors of the metric queries.
VECTORS_CTE = (
    SCORED_CTE
    + """, v AS (
  SELECT churn AS y, round_even(p, 6) AS p, monthly_recurring_revenue AS mrr FROM scored
)"""
)


def split_cte(seed: int, shares: list[float]) -> str:
    """``ranked``: accounts with the number of shares their hash passes in their class."""
    cuts = ", ".join(f"quantile_cont(h, {share}) AS c{i}" for i, share in enumerate(shares))
    passed = " + ".join(f"(h >= c{i})::INTEGER" for i in range(len(shares)))
    return MART_CTE + f""", hashed AS (
  SELECT customer_id, churn,
    ('0x' || substr(md5('{seed}:' || customer_id::VARCHAR), 1, 13))::BIGINT::DOUBLE AS h FROM mart
), cuts AS (SELECT churn, {cuts} FROM hashed GROUP BY churn
), ranked AS (
  SELECT customer_id, hashed.churn, {passed} AS passed
  FROM hashed JOIN cuts ON hashed.churn IS NOT DISTINCT FROM cuts.churn
)"""


FOLD_CTE = split_cte(42, [i / 5 for i in range(1, 5)])


def literal_list(values) -> str:
    """DuckDB list of doubles."""
    return "[" + ", ".join(f"{v!r}e0" if "e" not in repr(v) else repr(v) for v in values) + "]"


def numeric_unpivot(source: str, columns=NUMERIC_FEATURES) -> str:
    """(feature, value) rows of numeric columns, nulls left out."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c}::DOUBLE AS value FROM {source} WHERE {c} IS NOT NULL"
        for c in columns
    )


def category_unpivot(source: str, columns=CATEGORICAL_FEATURES) -> str:
    """(feature, category) rows of categorical columns, nulls left out."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c}::VARCHAR AS category FROM {source} WHERE {c} IS NOT NULL"
        for c in columns
    )
