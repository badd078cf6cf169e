"""Feature-engineering queries."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountrisk.functions import ratios as R
from accountrisk.operators import stages as S
from accountrisk.operators.encoding import TargetEncoder
from accountrisk.plans.catalog import query
from accountrisk.plans.intake import RATIO_SQL
from accountrisk.plans.sql import FOLD_CTE, MART_CTE
from accountrisk.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES, RATIO_FEATURES
from accountrisk.session import written
from accountrisk.sources.mart import account_mart, table

RATIO_MART = MART_CTE + f", ratios AS (SELECT *, {RATIO_SQL} FROM mart)"


def mart_table(spark, folder, *columns: str) -> DataFrame:
    """The mart, or some of its columns, written once for jobs that pass over it several times."""
    mart = account_mart(spark, folder)
    return written(mart.select(*columns) if columns else mart, "mart")


def number_table(spark, folder) -> DataFrame:
    return mart_table(spark, folder, "customer_id", *NUMERIC_FEATURES)


def rounded_columns(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.bround(c, digits) for c in columns})


def _ratio_query(name, column, expression):
    @query(
        name,
        RATIO_MART + f" SELECT customer_id, {column} FROM ratios",
    )
    def run(spark, folder):
        return account_mart(spark, folder).select("customer_id", expression().alias(column))

    return run


_ratio_query("q_feat_seat_utilization", "seat_utilization_rate", R.seat_utilization)
_ratio_query("q_feat_unresolved_ratio", "unresolved_tickets_ratio", R.unresolved_ratio)
_ratio_query("q_feat_logins_per_active", "avg_logins_per_active_user", R.logins_per_active)
_ratio_query("q_feat_mrr_per_seat", "mrr_per_contracted_seat", R.mrr_per_seat)


@query("q_feat_ratios", RATIO_MART + " SELECT * FROM ratios")
def feat_ratios(spark, folder):
    return S.RatioFeatures().transform(account_mart(spark, folder))


@query(
    "q_feat_declared_ratios",
    MART_CTE
    + """ SELECT customer_id,
  round_even(support_tickets_count::DOUBLE / (active_users_last_30d::DOUBLE + 1e-5), 6)
    AS ticket_to_user_ratio,
  round_even(1e0 - least(unresolved_tickets_count::DOUBLE
    / (support_tickets_count::DOUBLE + 1e-5), 1e0), 6) AS ticket_resolution_rate,
  round_even(monthly_recurring_revenue / greatest(active_users_last_30d::DOUBLE, 1e0), 6)
    AS mrr_per_active_seat FROM mart""",
)
def feat_declared_ratios(spark, folder):
    return account_mart(spark, folder).select(
        "customer_id",
        *[F.bround(e, 6).alias(n) for n, e in R.declared_ratio_columns().items()],
    )


def quantile_rows(columns, probs: dict[str, float], source: str = "mart") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, "
        + ", ".join(f"quantile_cont({c}::DOUBLE, {p!r}) AS {n}" for n, p in probs.items())
        + f" FROM {source}"
        for c in columns
    )


def learned_rows(spark, model, names: list[str]) -> DataFrame:
    """The fitted numbers of a stage as a table (one row per column)."""
    return spark.createDataFrame(
        [(c, *[round(v, 6) for v in values]) for c, values in model.learned().items()],
        "feature string, " + ", ".join(f"{n} double" for n in names),
    )


@query(
    "q_feat_winsor_fit",
    MART_CTE
    + ", q AS ("
    + quantile_rows(NUMERIC_FEATURES, {"lower_bound": 0.01, "upper_bound": 0.99})
    + ") SELECT feature, round_even(lower_bound, 6) AS lower_bound,"
    + " round_even(upper_bound, 6) AS upper_bound FROM q",
)
def feat_winsor_fit(spark, folder):
    model = S.Winsorizer(inputCols=NUMERIC_FEATURES).fit(number_table(spark, folder))
    return learned_rows(spark, model, ["lower_bound", "upper_bound"])


def _interpolated(values: str, prob: float) -> str:
    """Quantile of a sorted DuckDB list, written out so that the last bit is defined."""
    at = f"{prob}e0 * (len({values}) - 1)"
    low = f"{values}[floor({at})::BIGINT + 1]"
    high = f"{values}[least(floor({at})::BIGINT + 2, len({values}))]"
    return f"{low} + ({high} - {low}) * ({at} - floor({at}))"


def _clipped_sql(columns, lower, upper):
    lists = ", ".join(
        f"list_sort(list({c}::DOUBLE) FILTER (WHERE {c} IS NOT NULL)) AS {c}_s" for c in columns
    )
    bounds = ", ".join(
        f"{_interpolated(f'{c}_s', lower)} AS {c}_lo, {_interpolated(f'{c}_s', upper)} AS {c}_hi"
        for c in columns
    )
    clipped = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}::DOUBLE, {c}_lo), {c}_hi) END AS {c}"
        for c in columns
    )
    return (
        f", s AS (SELECT {lists} FROM mart), b AS (SELECT {bounds} FROM s)"
        f" SELECT customer_id, {clipped} FROM mart, b"
    )


@query("q_feat_winsor_apply", MART_CTE + _clipped_sql(NUMERIC_FEATURES, 0.01, 0.99))
def feat_winsor_apply(spark, folder):
    mart = number_table(spark, folder)
    model = S.Winsorizer(inputCols=NUMERIC_FEATURES).fit(mart)
    return model.transform(mart).select("customer_id", *NUMERIC_FEATURES)


@query("q_join_fit_state", MART_CTE + _clipped_sql(["monthly_recurring_revenue"], 0.05, 0.95))
def join_fit_state(spark, folder):
    """Learned bounds enter the plan as constants: no join, no shuffle."""
    mart = mart_table(spark, folder, "customer_id", "monthly_recurring_revenue")
    model = S.Winsorizer(inputCols=["monthly_recurring_revenue"], lower=0.05, upper=0.95).fit(mart)
    return model.transform(mart).select("customer_id", "monthly_recurring_revenue")


@query(
    "q_feat_log1p",
    MART_CTE
    + " SELECT customer_id, "
    + ", ".join(
        f"round_even(ln(1e0 + greatest(coalesce({c}::DOUBLE, 0e0), 0e0)), 6) AS {c}"
        for c in NUMERIC_FEATURES
    )
    + " FROM mart",
)
def feat_log1p(spark, folder):
    out = S.Log1p(inputCols=NUMERIC_FEATURES).transform(account_mart(spark, folder))
    return rounded_columns(out.select("customer_id", *NUMERIC_FEATURES), NUMERIC_FEATURES)


def _over_quantiles(columns, expression: str) -> str:
    """SELECT with per-column quantiles q25, q50, q75 available as {c}_25 ..."""
    stats = ", ".join(
        f"quantile_cont({c}::DOUBLE, 0.{p}) AS {c}_{p}" for c in columns for p in ("25", "5", "75")
    )
    out = ", ".join(f"{expression.format(c=c)} AS {c}" for c in columns)
    return f", st AS (SELECT {stats} FROM mart) SELECT customer_id, {out} FROM mart, st"


@query(
    "q_feat_impute_median",
    MART_CTE + _over_quantiles(NUMERIC_FEATURES, "coalesce({c}::DOUBLE, {c}_5)"),
)
def feat_impute_median(spark, folder):
    mart = number_table(spark, folder)
    model = S.MedianImputer(inputCols=NUMERIC_FEATURES).fit(mart)
    return model.transform(mart).select("customer_id", *NUMERIC_FEATURES)


@query(
    "q_feat_robust_scale",
    MART_CTE
    + _over_quantiles(
        NUMERIC_FEATURES,
        "round_even(({c}::DOUBLE - {c}_5)"
        " / CASE WHEN {c}_75 = {c}_25 THEN 1e0 ELSE {c}_75 - {c}_25 END, 9)",
    ),
)
def feat_robust_scale(spark, folder):
    mart = number_table(spark, folder)
    model = S.RobustColumnScaler(inputCols=NUMERIC_FEATURES).fit(mart)
    out = model.transform(mart).select("customer_id", *NUMERIC_FEATURES)
    return rounded_columns(out, NUMERIC_FEATURES, 9)


@query(
    "q_feat_standard_scale",
    MART_CTE
    + ", st AS (SELECT "
    + ", ".join(
        f"avg({c}::DOUBLE) AS {c}_m, stddev_pop({c}::DOUBLE) AS {c}_s" for c in NUMERIC_FEATURES
    )
    + " FROM mart) SELECT customer_id, "
    + ", ".join(
        f"round_even(({c}::DOUBLE - {c}_m) / {c}_s, 6) AS {c}" for c in NUMERIC_FEATURES
    )
    + " FROM mart, st",
)
def feat_standard_scale(spark, folder):
    mart = number_table(spark, folder)
    model = S.StandardColumnScaler(inputCols=NUMERIC_FEATURES).fit(mart)
    out = model.transform(mart).select("customer_id", *NUMERIC_FEATURES)
    return rounded_columns(out, NUMERIC_FEATURES)


@query(
    "q_feat_impute_constant",
    MART_CTE
    + " SELECT customer_id, CASE WHEN nps_score IS NULL THEN 'missing' ELSE plan_tier END"
    + " AS cat__plan_tier, auto_renew_enabled::VARCHAR AS cat__auto_renew_enabled FROM mart",
)
def feat_impute_constant(spark, folder):
    """Plan of accounts without a survey answer withheld, then filled with its own category."""
    mart = account_mart(spark, folder).withColumn(
        "plan_tier", F.when(F.col("nps_score").isNotNull(), F.col("plan_tier"))
    )
    filled = S.CategoryCopies(inputCols=["plan_tier", "auto_renew_enabled"]).transform(mart)
    return filled.select("customer_id", "cat__plan_tier", "cat__auto_renew_enabled")


ONE_HOT_INPUTS = ["plan_tier", "billing_cycle", "auto_renew_enabled"]
ONE_HOT_COLUMNS = {
    "plan_tier_enterprise": "plan_tier = 'Enterprise'",
    "plan_tier_professional": "plan_tier = 'Professional'",
    "plan_tier_starter": "plan_tier = 'Starter'",
    "billing_annual": "billing_cycle = 'Annual'",
    "billing_monthly": "billing_cycle = 'Monthly'",
    "billing_multi_year": "billing_cycle = 'Multi-Year'",
    "auto_renew_true": "auto_renew_enabled",
}


@query(
    "q_feat_one_hot",
    MART_CTE
    + " SELECT customer_id, "
    + ", ".join(f"({e})::INTEGER::DOUBLE AS {n}" for n, e in ONE_HOT_COLUMNS.items())
    + " FROM mart",
)
def feat_one_hot(spark, folder):
    mart = S.CategoryCopies(inputCols=ONE_HOT_INPUTS).transform(mart_table(spark, folder, "customer_id", *ONE_HOT_INPUTS))
    cat = [f"cat__{c}" for c in ONE_HOT_INPUTS]
    hot = S.OneHot(inputCols=cat).fit(mart).transform(mart)
    flat = F.flatten(F.array(*[vector_to_array(f"{c}__hot") for c in cat]))
    return hot.select(
        "customer_id", *[flat[i].alias(n) for i, n in enumerate(ONE_HOT_COLUMNS)]
    )


def nation_mart(spark, folder) -> DataFrame:
    """Label and nation name (25 values) per account."""
    customer = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return written(
        account_mart(spark, folder)
        .join(customer, F.col("customer_id") == F.col("c_custkey"))
        .select("customer_id", "churn", F.col("n_name").alias("nation")),
        "nation-mart",
    )


ENCODING_SQL = FOLD_CTE + """, m AS (
  SELECT customer_id, churn::DOUBLE AS y, n_name AS nation, passed AS te_fold
  FROM ranked JOIN customer ON c_custkey = customer_id JOIN nation ON n_nationkey = c_nationkey
), folds AS (
  SELECT DISTINCT te_fold FROM m
), rest AS (
  SELECT f.te_fold, m.nation, m.y FROM folds f JOIN m ON m.te_fold <> f.te_fold
), base AS (
  SELECT te_fold, avg(y) AS b, var_pop(y) AS v FROM rest GROUP BY te_fold
), cat AS (
  SELECT te_fold, nation, count(*)::DOUBLE AS n, avg(y) AS ybar FROM rest GROUP BY te_fold, nation
), enc AS (
  SELECT c.te_fold, nation,
    v * n / (v * n + ybar * (1e0 - ybar)) AS lam, ybar, b FROM cat c JOIN base USING (te_fold)
)
SELECT m.customer_id, m.te_fold, m.nation,
  round_even(coalesce(lam * ybar + (1e0 - lam) * enc.b, base.b), 6) AS nation_encoding
FROM m JOIN base USING (te_fold)
LEFT JOIN enc ON enc.te_fold = m.te_fold AND enc.nation = m.nation"""


@query("q_feat_target_encode", ENCODING_SQL)
def feat_target_encode(spark, folder):
    """Out-of-fold smoothed churn rate of each account's nation, by the folds of the cross-fitted pipeline."""
    pipeline = S.pipeline_of([TargetEncoder(inputCol="nation", outputCol="nation_encoding")], ["nation"])
    rows = pipeline.folded(nation_mart(spark, folder))
    out = pipeline.fit(rows).transform(rows)
    return rounded_columns(out, ["nation_encoding"]).drop("churn")


@query(
    "q_feat_assemble",
    MART_CTE
    + ", st AS (SELECT "
    + ", ".join(f"quantile_cont({c}::DOUBLE, 0.5) AS {c}_5" for c in NUMERIC_FEATURES)
    + " FROM mart) SELECT customer_id, "
    + ", ".join(f"coalesce({c}::DOUBLE, {c}_5) AS x_{c}" for c in NUMERIC_FEATURES)
    + " FROM mart, st",
)
def feat_assemble(spark, folder):
    """Feature vector of every account, missing numbers filled first, read back slot by slot."""
    mart = S.NumericCopies(inputCols=NUMERIC_FEATURES).transform(number_table(spark, folder))
    num = [f"num__{c}" for c in NUMERIC_FEATURES]
    filled = S.MedianImputer(inputCols=num).fit(mart).transform(mart)
    return (
        VectorAssembler(inputCols=num, outputCol="features", handleInvalid="error")
        .transform(filled)
        .withColumn("x", vector_to_array("features"))
        .select("customer_id", *[F.col("x")[i].alias(f"x_{c}") for i, c in enumerate(NUMERIC_FEATURES)])
    )


def preprocessor_sql() -> str:
    """The whole preprocessor: fill, clip, log and scale of numbers and ratios, then the indicators."""
    numbers = [*NUMERIC_FEATURES, *RATIO_FEATURES]

    def each(expression: str) -> str:
        return ", ".join(expression.format(c=c) for c in numbers)

    kept = ", ".join(f"{c}::VARCHAR AS {c}" for c in CATEGORICAL_FEATURES)
    named = ", ".join(CATEGORICAL_FEATURES)
    values = ", ".join(f"list_sort(list_distinct(list(coalesce({c}, 'missing')))) AS {c}_v" for c in CATEGORICAL_FEATURES)
    indicators = ", ".join(
        f"[CASE WHEN x = coalesce({c}, 'missing') THEN 1e0 ELSE 0e0 END"
        f" FOR x IN CASE WHEN len({c}_v) = 2 THEN {c}_v[2:] ELSE {c}_v END]"
        for c in CATEGORICAL_FEATURES
    )
    return (
        RATIO_MART
        + f", f0 AS (SELECT customer_id, {kept}, {each('{c}::DOUBLE AS {c}')} FROM ratios)"
        + f", f1 AS (SELECT customer_id, {named}, {each('coalesce({c}, median({c}) OVER ()) AS {c}')} FROM f0)"
        + f", lim AS (SELECT {each('quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi')} FROM f1)"
        + f", f2 AS (SELECT customer_id, {named},"
        + f" {each('ln(1e0 + greatest(least(greatest({c}, {c}_lo), {c}_hi), 0e0)) AS {c}')} FROM f1, lim)"
        + ", mid AS (SELECT "
        + each("quantile_cont({c}, 0.25) AS {c}_25, quantile_cont({c}, 0.5) AS {c}_50, quantile_cont({c}, 0.75) AS {c}_75")
        + f", {values} FROM f2)"
        + " SELECT customer_id, list_concat(["
        + each("round_even(({c} - {c}_50) / CASE WHEN {c}_75 = {c}_25 THEN 1e0 ELSE {c}_75 - {c}_25 END, 6)")
        + f"], flatten([{indicators}])) AS features FROM f2, mid"
    )


@query("q_feat_preprocessor", preprocessor_sql())
def feat_preprocessor(spark, folder):
    mart = mart_table(spark, folder, "customer_id", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES)
    fitted = S.build_preprocessor(NUMERIC_FEATURES, CATEGORICAL_FEATURES).fit(mart)
    slots = F.transform(vector_to_array("features"), lambda x: F.bround(x, 6))
    return fitted.transform(mart).select("customer_id", slots.alias("features"))


@query("q_feat_full_model")
def feat_full_model(spark, folder):
    """Preprocessor and classifier fitted and applied as one unit."""
    mart = mart_table(spark, folder)
    model = S.build_full(
        S.build_preprocessor(NUMERIC_FEATURES, CATEGORICAL_FEATURES),
        LogisticRegression(labelCol="churn"),
    ).fit(mart)
    return model.transform(mart).select(
        "customer_id", F.bround(vector_to_array("probability")[1], 4).alias("churn_probability")
    )
