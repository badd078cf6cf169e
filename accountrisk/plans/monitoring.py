"""Drift, profile and set-operation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountrisk.operators import drift as D
from accountrisk.plans.catalog import query
from accountrisk.plans.feature import mart_table
from accountrisk.plans.sql import MART_CTE, TWO_MARTS_CTE, category_unpivot, numeric_unpivot
from accountrisk.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from accountrisk.session import new_path, written
from accountrisk.sources.accounts import append_report, load_baseline, save_baseline
from accountrisk.sources.mart import EARLIER_SNAPSHOT, SNAPSHOT, account_mart, account_snapshots, table

FEATURES = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]

def batches(spark, folder, columns) -> tuple[DataFrame, DataFrame]:
    """The accounts of a year ago and those of now, from one pass over the source tables."""
    days = [EARLIER_SNAPSHOT, SNAPSHOT]
    rows = written(account_snapshots(spark, folder, days).select("snapshot", *columns), "snapshots")
    return tuple(rows.where(F.col("snapshot") == day).drop("snapshot") for day in days)


LONG = (
    TWO_MARTS_CTE
    + f", r AS ({numeric_unpivot('earlier')}), c AS ({numeric_unpivot('mart')})"
    + ", tagged AS (SELECT *, 1 AS is_ref FROM r UNION ALL SELECT *, 0 FROM c)"
)


def psi_sql(tagged: str = "tagged") -> str:
    """CTEs of the numeric index over (feature, value, is_ref)."""
    return f""", edges AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(value,
    [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
  FROM {tagged} WHERE is_ref = 1 GROUP BY feature
), binned AS (
  SELECT feature, is_ref, value, len([x FOR x IN e[2:len(e) - 1] IF x <= value]) AS bin
  FROM {tagged} JOIN edges USING (feature)
), bin_counts AS (
  SELECT feature, bin, sum(is_ref)::DOUBLE AS n_ref, sum(1 - is_ref)::DOUBLE AS n_cur
  FROM binned GROUP BY feature, bin
), grid AS (
  SELECT feature, unnest(range(greatest(len(e) - 1, 1))) AS bin, greatest(len(e) - 1, 1) AS k
  FROM edges
), sizes AS (
  SELECT feature, sum(is_ref)::DOUBLE AS all_ref, sum(1 - is_ref)::DOUBLE AS all_cur
  FROM {tagged} GROUP BY feature
), shares AS (
  SELECT g.feature, (coalesce(n_ref, 0) + 1e-4) / (all_ref + 1e-4 * k) AS rp,
    (coalesce(n_cur, 0) + 1e-4) / (all_cur + 1e-4 * k) AS cp
  FROM grid g JOIN sizes USING (feature)
  LEFT JOIN bin_counts b ON b.feature = g.feature AND b.bin = g.bin
), psi AS (
  SELECT feature, greatest(sum((cp - rp) * ln(cp / rp)), 0e0) AS psi FROM shares GROUP BY feature
)"""


def ks_sql(tagged: str = "tagged") -> str:
    """CTEs of both distribution functions and their distances."""
    return f""", steps AS (
  SELECT feature, value, sum(is_ref)::DOUBLE AS n_ref, sum(1 - is_ref)::DOUBLE AS n_cur
  FROM {tagged} GROUP BY feature, value
), ecdf AS (
  SELECT feature, value, sum(n_ref) OVER w / sum(n_ref) OVER (PARTITION BY feature) AS f_ref,
    sum(n_cur) OVER w / sum(n_cur) OVER (PARTITION BY feature) AS f_cur,
    lead(value) OVER w AS next_value, sum(n_ref) OVER (PARTITION BY feature) AS all_ref,
    sum(n_cur) OVER (PARTITION BY feature) AS all_cur
  FROM steps WINDOW w AS (PARTITION BY feature ORDER BY value)
), dist AS (
  SELECT feature, max(abs(f_ref - f_cur)) AS d,
    coalesce(sum(abs(f_ref - f_cur) * (next_value - value)), 0e0) AS w,
    max(all_ref)::BIGINT AS n, max(all_cur)::BIGINT AS m,
    max(all_ref) * max(all_cur) / (max(all_ref) + max(all_cur)) AS en
  FROM ecdf GROUP BY feature
), walk AS (
  SELECT feature, n, m, h, b, 0::BIGINT AS k, 0::BIGINT AS c,
    [CASE WHEN t = b THEN 1e0 ELSE 0e0 END FOR t IN range(2 * b + 1)] AS p
  FROM (SELECT feature, n, m, h, h // (n + m) + 2 AS b
    FROM (SELECT *, round(d * n * m)::BIGINT AS h FROM dist) WHERE h > 0 AND greatest(n, m) <= {D.EXACT_ROWS})
  UNION ALL
  SELECT feature, n, m, h, b, k + 1, (k + 1) * n // (n + m),
    [CASE WHEN i < 0 OR i > n OR k + 1 - i < 0 OR k + 1 - i > m OR abs(i * m - (k + 1 - i) * n) >= h THEN 0e0
      ELSE (coalesce(p[i - 1 - c + b + 1], 0e0) * i + coalesce(p[i - c + b + 1], 0e0) * (k + 1 - i)) / (k + 1) END
     FOR i IN range((k + 1) * n // (n + m) - b, (k + 1) * n // (n + m) + b + 1)]
  FROM walk WHERE k < n + m
), exact AS (
  SELECT feature, least(greatest(1e0 - p[b + 1], 0e0), 1e0) AS exact_p FROM walk WHERE k = n + m
), ks AS (
  SELECT feature, d, w, CASE WHEN exact_p IS NOT NULL THEN exact_p
    WHEN greatest(n, m) <= {D.EXACT_ROWS} OR x < 0.2e0 THEN 1e0 ELSE least(greatest(2e0 * list_sum(
      [CASE WHEN j % 2 = 1 THEN 1e0 ELSE -1e0 END * exp(-2e0 * j * j * x * x)
       FOR j IN range(1, 101)]), 0e0), 1e0) END AS pvalue
  FROM (SELECT *, (sqrt(en) + 0.12e0 + 0.11e0 / sqrt(en)) * d AS x FROM dist) LEFT JOIN exact USING (feature)
)"""


CATEGORIES = (
    TWO_MARTS_CTE
    + f", cr AS ({category_unpivot('earlier')}), cc AS ({category_unpivot('mart')})"
    + ", ctagged AS (SELECT *, 1 AS is_ref FROM cr UNION ALL SELECT *, 0 FROM cc)"
)


def category_psi_sql(tagged: str = "ctagged") -> str:
    return f""", ccounts AS (
  SELECT feature, category, sum(is_ref)::DOUBLE AS n_ref, sum(1 - is_ref)::DOUBLE AS n_cur
  FROM {tagged} GROUP BY feature, category
), cshares AS (
  SELECT feature, (n_ref + 1e-4) / (sum(n_ref) OVER f + 1e-4 * count(*) OVER f) AS rp,
    (n_cur + 1e-4) / (sum(n_cur) OVER f + 1e-4 * count(*) OVER f) AS cp
  FROM ccounts WINDOW f AS (PARTITION BY feature)
), cpsi AS (
  SELECT feature, greatest(sum((cp - rp) * ln(cp / rp)), 0e0) AS psi FROM cshares GROUP BY feature
)"""


@query(
    "q_drift_scenario",
    MART_CTE
    + ", enterprise AS (SELECT * FROM mart WHERE plan_tier = 'Enterprise')"
    + f", r AS ({numeric_unpivot('mart')}), c AS ({numeric_unpivot('enterprise')})"
    + ", tagged AS (SELECT *, 1 AS is_ref FROM r UNION ALL SELECT *, 0 FROM c)"
    + psi_sql()
    + " SELECT feature, round_even(psi, 6) AS psi FROM psi",
)
def drift_scenario(spark, folder):
    """What the audit would say of a portfolio that kept its Enterprise accounts only."""
    mart = mart_table(spark, folder, "plan_tier", *NUMERIC_FEATURES)
    psi = D.psi_numeric(mart, mart.where("plan_tier = 'Enterprise'"), NUMERIC_FEATURES)
    return psi.withColumn("psi", F.bround("psi", 6))


PROFILE_SQL = (
    MART_CTE
    + f", r AS ({numeric_unpivot('mart')})"
    + " SELECT feature, round_even(avg(value), 4) AS mean, round_even(stddev_samp(value), 4) AS std,"
    + " round_even(min(value), 4) AS min, round_even(max(value), 4) AS max,"
    + " round_even(median(value), 4) AS median, "
    + ", ".join(
        f"round_even(quantile_cont(value, {p!r}), 4) AS {n}" for n, p in D.PROFILE_PROBS.items()
    )
    + " FROM r GROUP BY feature"
)


@query("q_agg_baseline_numeric", PROFILE_SQL)
def agg_baseline_numeric(spark, folder):
    profile = D.numeric_profile(mart_table(spark, folder, *NUMERIC_FEATURES), NUMERIC_FEATURES)
    return profile.withColumns(
        {c: F.bround(c, 4) for c in profile.columns if c != "feature"}
    )


CATEGORY_PROFILE = (
    MART_CTE
    + f", r AS ({category_unpivot('mart')})"
    + ", g AS (SELECT feature, category, count(*)::BIGINT AS n FROM r GROUP BY feature, category)"
    + " SELECT feature, category, n,"
    + " round_even(n / sum(n) OVER (PARTITION BY feature)::DOUBLE, 6) AS proportion,"
    + " count(*) OVER (PARTITION BY feature)::BIGINT AS unique_count FROM g"
)


@query("q_agg_baseline_categorical", CATEGORY_PROFILE)
def agg_baseline_categorical(spark, folder):
    profile = D.categorical_profile(account_mart(spark, folder), CATEGORICAL_FEATURES)
    return profile.withColumn("proportion", F.bround("proportion", 6))


@query(
    "q_agg_baseline_summary",
    MART_CTE
    + f", r AS ({numeric_unpivot('mart')}), k AS ({category_unpivot('mart')})"
    + " SELECT feature, 'numeric' AS feature_type, (SELECT count(*) FROM mart)::BIGINT AS n_samples,"
    + " round_even(avg(value), 4) AS mean, round_even(median(value), 4) AS median,"
    + " NULL::BIGINT AS unique_count FROM r GROUP BY feature UNION ALL"
    + " SELECT feature, 'categorical', (SELECT count(*) FROM mart)::BIGINT, NULL::DOUBLE,"
    + " NULL::DOUBLE, count(DISTINCT category)::BIGINT FROM k GROUP BY feature",
)
def agg_baseline_summary(spark, folder):
    """Header count on both profile tables, one row per feature."""
    mart = mart_table(spark, folder, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES)
    numbers = D.numeric_profile(mart, NUMERIC_FEATURES).select(
        "feature",
        F.lit("numeric").alias("feature_type"),
        F.bround("mean", 4).alias("mean"),
        F.bround("median", 4).alias("median"),
        F.lit(None).cast("bigint").alias("unique_count"),
    )
    groups = (
        D.categorical_profile(mart, CATEGORICAL_FEATURES)
        .groupBy("feature")
        .agg(F.max("unique_count").alias("unique_count"))
        .select(
            "feature",
            F.lit("categorical").alias("feature_type"),
            F.lit(None).cast("double").alias("mean"),
            F.lit(None).cast("double").alias("median"),
            "unique_count",
        )
    )
    header = D.baseline_header(mart).first()
    return numbers.unionByName(groups).withColumn(
        "n_samples", F.lit(header["n_samples"]).cast("bigint")
    )


@query("q_drift_psi_numeric", LONG + psi_sql() + " SELECT feature, round_even(psi, 6) AS psi FROM psi")
def drift_psi_numeric(spark, folder):
    psi = D.psi_numeric(*batches(spark, folder, NUMERIC_FEATURES), NUMERIC_FEATURES)
    return psi.withColumn("psi", F.bround("psi", 6))


@query(
    "q_drift_psi_categorical",
    CATEGORIES + category_psi_sql() + " SELECT feature, round_even(psi, 6) AS psi FROM cpsi",
)
def drift_psi_categorical(spark, folder):
    psi = D.psi_categorical(*batches(spark, folder, CATEGORICAL_FEATURES), CATEGORICAL_FEATURES)
    return psi.withColumn("psi", F.bround("psi", 6))


@query("q_drift_ks_stat", LONG + ks_sql() + " SELECT feature, round_even(d, 6) AS ks_statistic FROM ks")
def drift_ks_stat(spark, folder):
    return D.distribution_distances(*batches(spark, folder, NUMERIC_FEATURES), NUMERIC_FEATURES).select(
        "feature", F.bround("ks_statistic", 6).alias("ks_statistic")
    )


@query("q_drift_ks_pvalue", LONG + ks_sql() + " SELECT feature, round_even(pvalue, 6) AS ks_pvalue FROM ks")
def drift_ks_pvalue(spark, folder):
    return D.distribution_distances(*batches(spark, folder, NUMERIC_FEATURES), NUMERIC_FEATURES).select(
        "feature", F.bround("ks_pvalue", 6).alias("ks_pvalue")
    )


@query("q_drift_wasserstein", LONG + ks_sql() + " SELECT feature, round_even(w, 4) AS wasserstein FROM ks")
def drift_wasserstein(spark, folder):
    return D.distribution_distances(*batches(spark, folder, NUMERIC_FEATURES), NUMERIC_FEATURES).select(
        "feature", F.bround("wasserstein", 4).alias("wasserstein")
    )


@query(
    "q_win_cumulative_ecdf",
    LONG
    + ks_sql()
    + " SELECT feature, value, round_even(f_ref, 6) AS f_ref, round_even(f_cur, 6) AS f_cur FROM ecdf",
)
def win_cumulative_ecdf(spark, folder):
    return D.ecdf(*batches(spark, folder, NUMERIC_FEATURES), NUMERIC_FEATURES).select(
        "feature", "value", F.bround("f_ref", 6).alias("f_ref"), F.bround("f_cur", 6).alias("f_cur")
    )


VERDICTS = (
    CATEGORIES
    + f", r AS ({numeric_unpivot('earlier')}), c AS ({numeric_unpivot('mart')})"
    + ", tagged AS (SELECT *, 1 AS is_ref FROM r UNION ALL SELECT *, 0 FROM c)"
    + psi_sql()
    + ks_sql()
    + category_psi_sql()
    + """, allm AS (
  SELECT feature, 'numeric' AS feature_type, psi, d AS ks_statistic, pvalue AS ks_pvalue
  FROM psi JOIN ks USING (feature)
  UNION ALL SELECT feature, 'categorical', psi, NULL, NULL FROM cpsi
), verdicts AS (
  SELECT feature, feature_type, round_even(psi, 4) AS psi,
    round_even(ks_statistic, 4) AS ks_statistic, round_even(ks_pvalue, 4) AS ks_pvalue,
    CASE WHEN psi >= 0.25e0 THEN 'DRIFT_DETECTED' WHEN psi >= 0.1e0 THEN 'WARNING'
      ELSE 'STABLE' END AS drift_level,
    psi >= 0.25e0 OR coalesce(ks_pvalue < 0.05e0 AND ks_statistic > 0.15e0, FALSE) AS has_drift
  FROM allm
)"""
)


SIZES = (
    ", n AS (SELECT (SELECT count(*) FROM earlier)::BIGINT AS n_earlier,"
    " (SELECT count(*) FROM mart)::BIGINT AS n_now)"
)


@query("q_drift_feature_verdict", VERDICTS + " SELECT * FROM verdicts")
def drift_feature_verdict(spark, folder):
    return D.feature_report(*batches(spark, folder, FEATURES), NUMERIC_FEATURES, CATEGORICAL_FEATURES)


@query(
    "q_drift_dataset_verdict",
    VERDICTS
    + " SELECT (count(*) FILTER (WHERE has_drift))::BIGINT AS drifted_features_count,"
    + " count(*)::BIGINT AS total_features_evaluated,"
    + " string_agg(feature, ',' ORDER BY feature) FILTER (WHERE has_drift) AS drifted_features,"
    + " count(*) FILTER (WHERE has_drift) >= 2 OR (count(*) FILTER (WHERE has_drift))::DOUBLE"
    + " / count(*) >= 0.2e0 AS is_dataset_drifted FROM verdicts",
)
def drift_dataset_verdict(spark, folder):
    verdict = D.dataset_verdict(drift_feature_verdict(spark, folder))
    return verdict.withColumn("drifted_features", F.array_join("drifted_features", ","))


@query(
    "q_drift_report",
    VERDICTS
    + SIZES
    + " SELECT n_earlier AS n_reference_samples, n_now AS n_current_samples,"
    + " count(*) FILTER (WHERE has_drift) OVER () >= 2 AS is_dataset_drifted,"
    + " feature, psi, ks_statistic, ks_pvalue, drift_level, has_drift FROM verdicts, n",
)
def drift_report(spark, folder):
    """The one-row report with its feature metrics spread into rows."""
    report = D.drift_report(*batches(spark, folder, FEATURES), NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    flat = report.select(
        "n_reference_samples", "n_current_samples", "is_dataset_drifted",
        F.inline("feature_metrics"),
    )
    return flat.drop("feature_type")


@query(
    "q_drift_from_baseline",
    CATEGORIES
    + f", r AS ({numeric_unpivot('earlier')}), c AS ({numeric_unpivot('mart')})"
    + ", tagged AS (SELECT *, 1 AS is_ref FROM r UNION ALL SELECT *, 0 FROM c)"
    + psi_sql()
    + category_psi_sql()
    + " SELECT feature, round_even(psi, 6) AS psi FROM psi"
    + " UNION ALL SELECT feature, round_even(psi, 6) FROM cpsi",
)
def drift_from_baseline(spark, folder):
    """Bins and category counts stored from last year's accounts, read back, then one pass each over this year's."""
    earlier, now = batches(spark, folder, FEATURES)
    path = save_baseline(
        D.baseline_bins(earlier, NUMERIC_FEATURES),
        D.categorical_profile(earlier, CATEGORICAL_FEATURES),
        new_path(spark, "baseline"),
    )
    numbers = D.psi_from_baseline(load_baseline(spark, path, "numeric"), now)
    groups = D.categorical_psi_from_baseline(load_baseline(spark, path, "categorical"), now)
    return numbers.unionByName(groups).withColumn("psi", F.bround("psi", 6))


@query(
    "q_sink_baseline",
    MART_CTE
    + f", r AS ({category_unpivot('mart')})"
    + " SELECT feature, category, count(*)::BIGINT AS n FROM r GROUP BY feature, category",
)
def sink_baseline(spark, folder):
    mart = account_mart(spark, folder)
    path = save_baseline(
        None, D.categorical_profile(mart, CATEGORICAL_FEATURES), new_path(spark, "baseline")
    )
    return load_baseline(spark, path, "categorical").select("feature", "category", "n")


@query(
    "q_sink_json_report",
    VERDICTS
    + SIZES
    + " SELECT max(n_earlier) AS n_reference_samples, max(n_now) AS n_current_samples,"
    + " (count(*) FILTER (WHERE has_drift))::INTEGER AS drifted_features_count,"
    + " count(*)::INTEGER AS total_features_evaluated,"
    + " count(*) FILTER (WHERE has_drift) >= 2 AS is_dataset_drifted FROM verdicts, n",
)
def sink_json_report(spark, folder):
    report = D.drift_report(*batches(spark, folder, FEATURES), NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    path = append_report(report, new_path(spark, "drift-reports"))
    return spark.read.schema(report.schema).json(path).select(
        "n_reference_samples", "n_current_samples", "drifted_features_count",
        "total_features_evaluated", "is_dataset_drifted",
    )


EVENT_HALVES = """WITH RECURSIVE e AS (
  SELECT *, (ts < TIMESTAMP '2024-01-16')::INTEGER AS is_ref FROM events
), tagged AS (SELECT 'value' AS feature, value, is_ref FROM e WHERE value IS NOT NULL
), ctagged AS (SELECT 'event_type' AS feature, event_type AS category, is_ref FROM e
  WHERE event_type IS NOT NULL)"""


@query(
    "q_drift_events",
    EVENT_HALVES
    + psi_sql()
    + ks_sql()
    + category_psi_sql()
    + " SELECT feature, round_even(psi, 6) AS psi, round_even(d, 6) AS ks_statistic,"
    + " round_even(w, 6) AS wasserstein FROM psi JOIN ks USING (feature)"
    + " UNION ALL SELECT feature, round_even(psi, 6), NULL, NULL FROM cpsi",
)
def drift_events(spark, folder):
    """Event values and types, first half of the month against the second."""
    events = table(spark, folder, "events").select("ts", "value", "event_type")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    before, after = events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)
    numbers = D.psi_numeric(before, after, ["value"]).join(
        D.distribution_distances(before, after, ["value"]), "feature"
    )
    types = D.psi_categorical(before, after, ["event_type"])
    return (
        numbers.unionByName(types, allowMissingColumns=True)
        .select(
            "feature",
            *[F.bround(c, 6).alias(c) for c in ("psi", "ks_statistic", "wasserstein")],
        )
    )


@query(
    "q_join_value_to_bin",
    MART_CTE
    + ", e AS (SELECT quantile_cont(monthly_recurring_revenue,"
    + " [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS inner_edges FROM mart)"
    + " SELECT customer_id, len([x FOR x IN inner_edges IF x <= monthly_recurring_revenue])::INTEGER"
    + " AS mrr_bin FROM mart, e",
)
def join_value_to_bin(spark, folder):
    mart = mart_table(spark, folder, "customer_id", "monthly_recurring_revenue")
    edges = D.bin_edges(mart, ["monthly_recurring_revenue"])["monthly_recurring_revenue"]
    return mart.select(
        "customer_id", D.value_bin("monthly_recurring_revenue", edges).alias("mrr_bin")
    )


@query(
    "q_join_category_union",
    CATEGORIES
    + " SELECT feature, category, sum(is_ref)::BIGINT AS n_ref, sum(1 - is_ref)::BIGINT AS n_cur"
    + " FROM ctagged GROUP BY feature, category",
)
def join_category_union(spark, folder):
    return D.category_counts(*batches(spark, folder, CATEGORICAL_FEATURES), CATEGORICAL_FEATURES)


PRIORITIES = """WITH early AS (SELECT o_orderpriority AS category, o_custkey FROM orders
  WHERE o_orderdate < TIMESTAMP '1998-01-01'),
late AS (SELECT o_orderpriority AS category, o_custkey FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""


def _order_periods(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("category"), "o_custkey", "o_orderdate"
    )
    split = F.lit("1998-01-01").cast("timestamp_ntz")
    return (
        orders.where(F.col("o_orderdate") < split).drop("o_orderdate"),
        orders.where(F.col("o_orderdate") >= split).drop("o_orderdate"),
    )


@query(
    "q_set_union_categories",
    PRIORITIES
    + " SELECT category FROM early UNION SELECT category FROM late ORDER BY category",
)
def set_union_categories(spark, folder):
    early, late = _order_periods(spark, folder)
    return early.select("category").union(late.select("category")).distinct().orderBy("category")


@query(
    "q_set_except_new_categories",
    PRIORITIES + " SELECT o_custkey FROM late EXCEPT SELECT o_custkey FROM early",
)
def set_except_new_categories(spark, folder):
    """Customer keys seen only in the later period."""
    early, late = _order_periods(spark, folder)
    return late.select("o_custkey").subtract(early.select("o_custkey"))
