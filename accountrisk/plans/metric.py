"""Metric queries on the scorecard's label, probability and revenue vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountrisk.functions.scoring import rule_probability
from accountrisk.operators import metrics as M
from accountrisk.plans.catalog import query
from accountrisk.plans.sql import MART_CTE, VECTORS_CTE, literal_list
from accountrisk.session import written
from accountrisk.sources.mart import account_mart

THRESHOLDS = literal_list(M.default_thresholds())
UNIFORM_INNER = literal_list(M.uniform_edges(10)[1:-1])


def vectors(spark, folder) -> DataFrame:
    """Label, score at six decimals and revenue of every account."""
    return account_mart(spark, folder).select(
        F.col("churn").alias("y"),
        F.bround(rule_probability(), 6).alias("p"),
        F.col("monthly_recurring_revenue").alias("mrr"),
    )


def vector_table(spark, folder) -> DataFrame:
    """The vectors written once, for metrics that pass over them several times."""
    return written(vectors(spark, folder), "vectors")


def decided(spark, folder, threshold: float) -> DataFrame:
    return vectors(spark, folder).withColumn("hit", (F.col("p") >= threshold).cast("int"))


@query(
    "q_agg_confusion",
    VECTORS_CTE
    + " SELECT (count(*) FILTER (WHERE y = 1 AND p >= 0.35e0))::BIGINT AS tp,"
    + " (count(*) FILTER (WHERE y = 0 AND p >= 0.35e0))::BIGINT AS fp,"
    + " (count(*) FILTER (WHERE y = 1 AND p < 0.35e0))::BIGINT AS fn,"
    + " (count(*) FILTER (WHERE y = 0 AND p < 0.35e0))::BIGINT AS tn FROM v",
)
def agg_confusion(spark, folder):
    return M.confusion(decided(spark, folder, 0.35), "y", "hit")


BENEFIT_SQL = """sum(CASE WHEN y = 1 AND p >= {t} THEN 0.65e0 * {ltv} - 150e0
    WHEN y = 0 AND p >= {t} THEN -150e0 WHEN y = 1 THEN -({ltv}) ELSE 0e0 END)"""


@query(
    "q_agg_net_benefit",
    VECTORS_CTE
    + f" SELECT round_even({BENEFIT_SQL.format(t='0.35e0', ltv='mrr * 12e0')}, 2) AS by_account,"
    + f" round_even({BENEFIT_SQL.format(t='0.35e0', ltv='10200e0')}, 2) AS by_default FROM v",
)
def agg_net_benefit(spark, folder):
    y, hit = F.col("y"), F.col("hit")
    return decided(spark, folder, 0.35).agg(
        F.bround(M.net_benefit(y, hit, F.col("mrr") * 12.0), 2).alias("by_account"),
        F.bround(M.net_benefit(y, hit), 2).alias("by_default"),
    )


@query(
    "q_agg_business_scorer",
    VECTORS_CTE
    + f" SELECT round_even({BENEFIT_SQL.format(t='0.5e0', ltv='mrr * 12e0')}, 2)"
    + " AS net_benefit_usd FROM v",
)
def agg_business_scorer(spark, folder):
    """The model-selection evaluator on the scorecard's decisions at 0.5."""
    rows = decided(spark, folder, 0.5).withColumn("ltv", F.col("mrr") * 12.0)
    value = M.NetBenefitEvaluator(labelCol="y", predictionCol="hit", ltvCol="ltv").evaluate(rows)
    return spark.createDataFrame([(round(value, 2),)], "net_benefit_usd double")


CURVE_SQL = (
    VECTORS_CTE
    + f""", cuts AS (
  SELECT unnest({THRESHOLDS}) AS threshold, generate_subscripts({THRESHOLDS}, 1) - 1 AS position
), curve AS (
  SELECT position::INTEGER AS position, threshold,
    (count(*) FILTER (WHERE y = 1 AND p >= threshold))::BIGINT AS tp,
    (count(*) FILTER (WHERE y = 0 AND p >= threshold))::BIGINT AS fp,
    (count(*) FILTER (WHERE y = 1 AND p < threshold))::BIGINT AS fn,
    round_even({BENEFIT_SQL.format(t='threshold', ltv='mrr * 12e0')}, 2) AS net_benefit_usd
  FROM v, cuts GROUP BY position, threshold
)"""
)


@query("q_agg_financial_curve", CURVE_SQL + " SELECT * FROM curve")
def agg_financial_curve(spark, folder):
    return M.financial_curve(vectors(spark, folder), "y", "p", "mrr")


@query("q_win_curve_suffix", CURVE_SQL + " SELECT position, tp, fp, fn FROM curve")
def win_curve_suffix(spark, folder):
    return agg_financial_curve(spark, folder).select("position", "tp", "fp", "fn")


@query(
    "q_agg_best_threshold",
    CURVE_SQL
    + " SELECT threshold AS best_threshold, net_benefit_usd AS max_net_benefit_usd,"
    + " tp AS tps_at_best, fp AS fps_at_best, fn AS fns_at_best FROM curve"
    + " ORDER BY net_benefit_usd DESC, position LIMIT 1",
)
def agg_best_threshold(spark, folder):
    return M.best_threshold(agg_financial_curve(spark, folder))


@query(
    "q_agg_brier",
    VECTORS_CTE + " SELECT round_even(avg((p - y) * (p - y)), 6) AS brier_score FROM v",
)
def agg_brier(spark, folder):
    return vectors(spark, folder).agg(
        F.bround(M.brier(F.col("y"), F.col("p")), 6).alias("brier_score")
    )


ECE_BINS = (
    VECTORS_CTE
    + ", b AS (SELECT *, len([e FOR e IN "
    + UNIFORM_INNER
    + " IF e {op} p]) AS bin FROM v), g AS (SELECT bin::INTEGER AS bin, count(*)::BIGINT AS n,"
    + " sum(y)::DOUBLE AS s, sum(p) AS q FROM b GROUP BY bin)"
)


@query(
    "q_agg_ece",
    ECE_BINS.format(op="<=") + " SELECT round_even(sum(abs(s - q)) / sum(n), 6) AS ece FROM g",
)
def agg_ece(spark, folder):
    return M.calibration_error(vectors(spark, folder), "y", "p").select(
        F.bround("ece", 6).alias("ece")
    )


CURVE_OUT = (
    " SELECT bin, n, round_even(s / n, 6) AS prob_true, round_even(q / n, 6) AS prob_pred FROM g"
)


def _rounded_curve(curve: DataFrame) -> DataFrame:
    return curve.withColumns({c: F.bround(c, 6) for c in ("prob_true", "prob_pred")})


@query("q_agg_reliability_uniform", ECE_BINS.format(op="<") + CURVE_OUT)
def agg_reliability_uniform(spark, folder):
    return _rounded_curve(M.reliability_curve(vectors(spark, folder), "y", "p"))


@query(
    "q_agg_reliability_quantile",
    VECTORS_CTE
    + f", e AS (SELECT quantile_cont(p, {UNIFORM_INNER}) AS inner_edges FROM v),"
    + " b AS (SELECT v.*, len([x FOR x IN inner_edges IF x < p]) AS bin FROM v, e),"
    + " g AS (SELECT bin::INTEGER AS bin, count(*)::BIGINT AS n, sum(y)::DOUBLE AS s, sum(p) AS q"
    + " FROM b GROUP BY bin)"
    + CURVE_OUT,
)
def agg_reliability_quantile(spark, folder):
    return _rounded_curve(
        M.reliability_curve(vector_table(spark, folder), "y", "p", strategy="quantile")
    )


RANKS_CTE = (
    VECTORS_CTE
    + """, t AS (
  SELECT p, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM v GROUP BY p
), r AS (
  SELECT *, coalesce(sum(pos) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS pos_before,
    coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS neg_before,
    sum(pos) OVER () AS pos_total, sum(neg) OVER () AS neg_total
  FROM t
)"""
)


@query(
    "q_win_rank_scores",
    RANKS_CTE
    + " SELECT p, pos::BIGINT AS pos, neg::BIGINT AS neg, pos_before::BIGINT AS pos_before,"
    + " neg_before::BIGINT AS neg_before FROM r",
)
def win_rank_scores(spark, folder):
    return M.score_ranks(vector_table(spark, folder), "y", "p").select(
        "p", "pos", "neg", "pos_before", "neg_before"
    )


@query(
    "q_agg_roc_auc",
    RANKS_CTE
    + " SELECT round_even(sum(pos * (neg_before + neg / 2)) / (max(pos_total) * max(neg_total)), 6)"
    + " AS roc_auc FROM r",
)
def agg_roc_auc(spark, folder):
    return M.ranking_metrics(vector_table(spark, folder), "y", "p").select(
        F.bround("roc_auc", 6).alias("roc_auc")
    )


@query(
    "q_agg_pr_auc",
    RANKS_CTE
    + " SELECT round_even(sum(pos * (pos_total - pos_before)"
    + " / (pos_total - pos_before + neg_total - neg_before)) / max(pos_total), 6) AS pr_auc FROM r",
)
def agg_pr_auc(spark, folder):
    return M.ranking_metrics(vector_table(spark, folder), "y", "p").select(
        F.bround("pr_auc", 6).alias("pr_auc")
    )


@query(
    "q_agg_f1",
    VECTORS_CTE
    + " SELECT round_even(2e0 * count(*) FILTER (WHERE y = 1 AND p >= 0.5e0)"
    + " / (2e0 * count(*) FILTER (WHERE y = 1 AND p >= 0.5e0)"
    + " + count(*) FILTER (WHERE y <> (p >= 0.5e0)::INTEGER)), 6) AS f1 FROM v",
)
def agg_f1(spark, folder):
    return decided(spark, folder, 0.5).agg(
        F.bround(M.f1_score(F.col("y"), F.col("hit")), 6).alias("f1")
    )


@query(
    "q_agg_class_weights",
    MART_CTE
    + ", c AS (SELECT churn, count(*)::BIGINT AS n_class FROM mart GROUP BY churn)"
    + " SELECT churn, n_class, round_even((SELECT sum(n_class)::DOUBLE FROM c)"
    + " / (2e0 * n_class), 6) AS weight FROM c",
)
def agg_class_weights(spark, folder):
    return M.class_weights(account_mart(spark, folder), "churn").withColumn(
        "weight", F.bround("weight", 6)
    )
