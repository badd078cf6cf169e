"""Split, training, calibration, explanation and registry queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountrisk.functions.scoring import rule_probability, score_accounts
from accountrisk.operators import calibration as C
from accountrisk.operators import importance as I
from accountrisk.operators import training as T
from accountrisk.operators import workflow as W
from accountrisk.operators.splits import class_share_rank, train_test_split, with_folds
from accountrisk.plans.catalog import query
from accountrisk.plans.feature import mart_table
from accountrisk.plans.sql import FOLD_CTE, MART_CTE, SCORED_CTE, split_cte
from accountrisk.schema import CATEGORICAL_FEATURES, DEFAULT_THRESHOLD, NUMERIC_FEATURES
from accountrisk.session import new_path, written
from accountrisk.sources import registry as G
from accountrisk.sources.mart import EARLIER_SNAPSHOT, SNAPSHOT, account_mart, account_snapshots


def label_table(spark, folder) -> DataFrame:
    """Ids and labels alone, which need no line items."""
    return written(account_mart(spark, folder).select("customer_id", "churn"), "labels")


SPLIT_SQL = split_cte(42, [0.2]) + """
SELECT customer_id, churn, CASE WHEN passed > 0 THEN 'train' ELSE 'test' END AS part FROM ranked"""


@query("q_ml_split", SPLIT_SQL)
def ml_split(spark, folder):
    mart = label_table(spark, folder)
    is_train = class_share_rank(mart, "churn", "customer_id", 42, [0.2]) > 0
    return mart.select(
        "customer_id", "churn", F.when(is_train, "train").otherwise("test").alias("part")
    )


@query("q_ml_kfold", FOLD_CTE + " SELECT customer_id, churn, passed AS fold FROM ranked")
def ml_kfold(spark, folder):
    mart = label_table(spark, folder)
    return with_folds(mart, "churn", "customer_id").select("customer_id", "churn", "fold")


@query(
    "q_win_fold_assignment",
    FOLD_CTE
    + """ SELECT passed AS fold, count(*) AS n_rows, sum(churn)::BIGINT AS n_churned
FROM ranked GROUP BY passed""",
)
def win_fold_assignment(spark, folder):
    """Rows and churned rows per fold."""
    return ml_kfold(spark, folder).groupBy("fold").agg(
        F.count("*").alias("n_rows"), F.sum("churn").alias("n_churned")
    )


def churn_pipeline(kind: str, **params) -> Pipeline:
    return T.make_pipeline(kind, NUMERIC_FEATURES, CATEGORICAL_FEATURES, **params)


def _account_scores(spark, folder, kind) -> DataFrame:
    """Held-out accounts scored by a model of all account features at its full settings."""
    train, test = train_test_split(mart_table(spark, folder), "churn", "customer_id")
    model = T.fit_pipeline(churn_pipeline(kind), train)
    return model.transform(test).select(
        "customer_id", "churn", F.bround(vector_to_array("probability")[1], 6).alias("probability")
    )


@query("q_ml_gbt")
def ml_gbt(spark, folder):
    return _account_scores(spark, folder, "gradient_boosting")


@query("q_ml_rf")
def ml_rf(spark, folder):
    return _account_scores(spark, folder, "random_forest")


@query("q_ml_logreg")
def ml_logreg(spark, folder):
    return _account_scores(spark, folder, "logistic_regression")


@query("q_ml_fit_plain")
def ml_fit_plain(spark, folder):
    train, test = train_test_split(mart_table(spark, folder), "churn", "customer_id")
    scored = T.fit_pipeline(churn_pipeline("random_forest"), train).transform(test)
    return score_accounts(
        scored.select("customer_id", "churn", vector_to_array("probability")[1].alias("p")),
        F.col("p"),
        0.5,
    ).drop("p")


#: Random points of the forest's grid that the search starts with, whatever the number of rows.
CANDIDATES = 6


@query("q_ml_halving_search")
def ml_halving_search(spark, folder):
    """Search history: candidates alive, rows used and mean AUC per rung."""
    _, _, history = T.halving_search(
        mart_table(spark, folder), churn_pipeline("random_forest"), T.SEARCH_SPACE["random_forest"],
        min_rows=1000, folds=5, candidates=CANDIDATES,
    )
    return spark.createDataFrame(history, "rung int, n_rows bigint, candidate string, metric double")


def _comparison(spark, folder) -> DataFrame:
    train, test = train_test_split(mart_table(spark, folder), "churn", "customer_id")
    table_, _ = T.compare_models(
        train,
        test,
        {
            "gradient_boosting": churn_pipeline("gradient_boosting"),
            "random_forest": churn_pipeline("random_forest"),
        },
    )
    return table_


@query("q_ml_compare")
def ml_compare(spark, folder):
    return _comparison(spark, folder).drop("position")


@query("q_argmax_champion")
def argmax_champion(spark, folder):
    return T.champion(_comparison(spark, folder))


def _calibrated(spark, folder, method, folds=5):
    train, test = train_test_split(mart_table(spark, folder), "churn", "customer_id")
    model = C.fit_calibrated(
        churn_pipeline("random_forest"), train, "churn", "customer_id", method, folds
    )
    return model, test


@query("q_cal_isotonic_cv")
def cal_isotonic_cv(spark, folder):
    model, test = _calibrated(spark, folder, "isotonic")
    return model.transform(test).select(
        "customer_id", "churn", F.bround("probability", 6).alias("probability")
    )


@query("q_cal_sigmoid_cv")
def cal_sigmoid_cv(spark, folder):
    model, test = _calibrated(spark, folder, "sigmoid")
    return model.transform(test).select(
        "customer_id", "churn", F.bround("probability", 6).alias("probability")
    )


@query(
    "q_cal_pava_binned",
    SCORED_CTE
    + """, s AS (
  SELECT round_even(p, 4) AS score, sum(churn)::DOUBLE AS hits, count(*)::DOUBLE AS weight FROM scored GROUP BY 1
), o AS (
  SELECT *, row_number() OVER w AS i, sum(hits) OVER w AS upto_hits, sum(weight) OVER w AS upto_weight
  FROM s WINDOW w AS (ORDER BY score)
), lows AS (
  SELECT b.i, min((b.upto_hits - a.upto_hits + a.hits) / (b.upto_weight - a.upto_weight + a.weight))
    OVER (PARTITION BY a.i ORDER BY b.i DESC) AS least
  FROM o a JOIN o b ON a.i <= b.i
)
SELECT score, weight::BIGINT AS weight, round_even(max(least), 6) AS calibrated
FROM o JOIN lows USING (i) GROUP BY score, weight""",
)
def cal_pava_binned(spark, folder):
    """Isotonic fit of the rule scorecard's probability against churn at every grouped score."""
    scores = account_mart(spark, folder).select("churn", rule_probability().alias("p"))
    found = C.calibrated_scores(written(scores, "scores"), "churn", "p", digits=4)
    return found.withColumn("calibrated", F.bround("calibrated", 6))


def _forest_importance(spark, folder) -> DataFrame:
    train, test = train_test_split(mart_table(spark, folder), "churn", "customer_id")
    model = T.fit_pipeline(churn_pipeline("random_forest"), train)
    return I.permutation_importance(
        model, test, [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES], "churn", "customer_id", repeats=5
    )


@query("q_xai_permutation")
def xai_permutation(spark, folder):
    return _forest_importance(spark, folder)


@query("q_topk_features")
def topk_features(spark, folder):
    return I.top_features(_forest_importance(spark, folder), 5)


@query(
    "q_join_permute",
    MART_CTE
    + """, hashed AS (
  SELECT customer_id, monthly_recurring_revenue,
    ('0x' || substr(md5('2:' || customer_id::VARCHAR), 1, 13))::BIGINT AS h FROM mart
)
SELECT customer_id, monthly_recurring_revenue,
  coalesce(lead(monthly_recurring_revenue) OVER (ORDER BY h, customer_id),
    first(monthly_recurring_revenue) OVER (ORDER BY h, customer_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS permuted
FROM hashed""",
)
def join_permute(spark, folder):
    """Each account beside the revenue it receives in one shuffle; one block holds the accounts here."""
    mart = mart_table(spark, folder, "customer_id", "monthly_recurring_revenue")
    return I.with_permuted(mart, ["monthly_recurring_revenue"], "customer_id", 1, seed=1, rows_per_block=10**9).select(
        "customer_id",
        "monthly_recurring_revenue",
        F.col("__permuted")[0]["monthly_recurring_revenue"].alias("permuted"),
    )


@query(
    "q_model_save_load",
    split_cte(42, [0.2]) + " SELECT customer_id, TRUE AS is_same FROM ranked WHERE passed = 0",
)
def model_save_load(spark, folder):
    """Held-out accounts and whether a model that was saved, registered, found as latest and loaded back scores them
    as before."""
    model, test = _calibrated(spark, folder, "isotonic")
    scored = model.transform(test).select("customer_id", F.col("probability").alias("p"))
    before = written(scored, "scores")  # one model at a time is in the driver
    root = new_path(spark, "models")
    G.save_model(
        model, spark, root, "account_risk", "0.1.0", "random_forest",
        [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES], DEFAULT_THRESHOLD,
    )
    del model, scored
    row = G.latest(spark, root, "account_risk")
    loaded = G.load_model(spark, row["path"], row["checksum"])
    after = loaded.transform(test).select("customer_id", "probability")
    return before.join(after, "customer_id").select("customer_id", (F.col("p") == F.col("probability")).alias("is_same"))


@query(
    "q_model_checksum",
    "SELECT 'account_risk' AS model_name, '0.1.0' AS version, 'logistic_regression' AS algorithm,"
    " count(*) > 0 AS checksum_matches FROM customer",
)
def model_checksum(spark, folder):
    """Registered checksum against the one computed from the files."""
    train = mart_table(spark, folder)
    model = T.fit_pipeline(churn_pipeline("logistic_regression"), train)
    root = new_path(spark, "models")
    row = G.save_model(
        model, spark, root, "account_risk", "0.1.0", "logistic_regression",
        [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES],
    )
    return G.registry(spark, root).select(
        "model_name", "version", "algorithm",
        (F.col("checksum") == G.model_checksum(spark, row["path"])).alias("checksum_matches"),
    )


@query("q_score_batch_model")
def score_batch_model(spark, folder):
    """Split, fit, compare, calibrate, choose the threshold, report and register, then score the accounts of a year ago
    with the registered model at its threshold."""
    both = written(account_snapshots(spark, folder, [EARLIER_SNAPSHOT, SNAPSHOT]), "snapshots")
    now = both.where(F.col("snapshot") == SNAPSHOT).drop("snapshot")
    root = new_path(spark, "models")
    W.train_and_register(now, root, ("random_forest", "logistic_regression"), search=False)
    earlier = both.where(F.col("snapshot") == EARLIER_SNAPSHOT).drop("snapshot")
    return W.score_registered(spark, root, earlier).select(
        "customer_id", "churn_probability", "churn_prediction", "decision_threshold", "risk_level"
    )
