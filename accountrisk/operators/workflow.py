"""From accounts to a registered model and back to scores, as one flow.

Split, search, compare, calibrate, choose the threshold, report, register; then score any batch with the registered model
at the registered threshold. The threshold is chosen on validation rows and everything reported on test rows, which no
earlier step has seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from accountrisk.functions.scoring import score_accounts
from accountrisk.operators import calibration as C
from accountrisk.operators import metrics as M
from accountrisk.operators import training as T
from accountrisk.operators.splits import train_test_split
from accountrisk.schema import (
    CATEGORICAL_FEATURES,
    ID_COLUMN,
    NUMERIC_FEATURES,
    RATIO_INPUTS,
    TARGET_COLUMN,
    BusinessTerms,
)
from accountrisk.session import written
from accountrisk.sources import registry as G

REVENUE = "monthly_recurring_revenue"


def calibration_report(scored: DataFrame, label: str, probability: str, n_bins: int = 10) -> tuple[DataFrame, DataFrame]:
    """(one row with rows, Brier score and expected calibration error; the reliability curve) of a model's scores."""
    y, p = F.col(label), F.col(probability)
    whole = scored.agg(F.count("*").alias("n_rows"), M.brier(y, p).alias("brier_score"))
    ece = M.calibration_error(scored, label, probability, n_bins)
    return whole.withColumn("ece", ece.scalar()), M.reliability_curve(scored, label, probability, n_bins)


def held_out_metrics(scored: DataFrame, label: str, threshold: float, value: str, terms: BusinessTerms) -> dict[str, float]:
    """Ranking, calibration and money of scored rows (``probability``), money and F1 at ``threshold``."""
    found = {}
    for name, metric in (("roc_auc", "roc_auc"), ("pr_auc", "pr_auc"), ("f1_score", "f1"), ("net_benefit_usd", "net_benefit")):
        found[name] = M.keyed_metric(scored, metric, label, "probability", [], value, threshold, terms).first()["metric"]
    report, _ = calibration_report(scored, label, "probability")
    row = report.first()
    found |= {"brier_score": row["brier_score"], "ece": row["ece"], "n_rows": row["n_rows"]}
    return {k: float(v) for k, v in found.items() if v is not None}


def train_and_register(
    accounts: DataFrame,
    root: str,
    kinds: Sequence[str] = ("gradient_boosting", "random_forest"),
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES),
    name: str = "account_risk",
    version: str = "0.1.0",
    search: bool = True,
    method: str = "isotonic",
    folds: int = 5,
    metric: M.Metric = "roc_auc",
    test_share: float = 0.2,
    validation_share: float = 0.2,
    label: str = TARGET_COLUMN,
    row_id: str = ID_COLUMN,
    value: str = REVENUE,
    terms: BusinessTerms = BusinessTerms(),
    seed: int = 42,
    settings: dict[str, dict] | None = None,
    **search_options,
) -> Row:
    """Registry row of the calibrated champion.

    Each kind is searched (:func:`training.halving_search`) or fitted plainly with ``settings``; the one with the best ``metric`` on
    the validation rows is calibrated by cross-fitting on the training rows, and its threshold maximises the net benefit on the
    validation rows.
    """
    spark = accounts.sparkSession
    rows = written(accounts.select(*dict.fromkeys([row_id, label, value, *numeric, *categorical, *RATIO_INPUTS])), "flow")
    rest, test = train_test_split(rows, label, row_id, test_share, seed)
    train, validation = train_test_split(rest, label, row_id, validation_share / (1.0 - test_share), seed + 1)

    best = None
    for kind in kinds:
        own = dict((settings or {}).get(kind, {}))
        pipeline = T.make_pipeline(kind, numeric, categorical, label, seed, **own)
        if search and kind in T.SEARCH_SPACE:
            model, found, _ = T.halving_search(
                train, pipeline, T.SEARCH_SPACE[kind], label, row_id, folds=folds, seed=seed, metric=metric,
                value=value, **search_options,
            )
            own |= found
        else:
            model = T.fit_pipeline(pipeline, train)
        scored = model.transform(validation)
        scored = scored.select(label, value, M.positive_probability(scored, "probability").alias("probability"))
        reached = M.keyed_metric(scored, metric, label, "probability", [], value, terms=terms).first()["metric"]
        if best is None or (reached or 0.0) > best[0]:
            best = (reached or 0.0, kind, own)
    _, kind, own = best

    pipeline = T.make_pipeline(kind, numeric, categorical, label, seed, **own)
    model = C.fit_calibrated(pipeline, train, label, row_id, method, folds, seed)
    kept = [label, value, "probability"]
    checked = written(model.transform(validation).select(*kept), "validation")
    curve = M.financial_curve(checked, label, "probability", value, terms=terms)
    threshold = M.best_threshold(curve).first()["best_threshold"]
    reported = written(model.transform(test).select(*kept), "test")
    return G.save_model(
        model, spark, root, name, version, kind, [*numeric, *categorical], threshold,
        target_column=label,
        validation_metrics=held_out_metrics(reported, label, threshold, value, terms),
        business_parameters={
            "intervention_cost": terms.intervention_cost, "success_rate": terms.success_rate,
            "ltv_multiplier": terms.ltv_multiplier,
        },
    )


def score_registered(spark: SparkSession, root: str, accounts: DataFrame, name: str = "account_risk") -> DataFrame:
    """``accounts`` scored by the newest registered model of that name at its registered threshold."""
    row = G.latest(spark, root, name)
    model = G.load_model(spark, row["path"], row["checksum"])
    scored = model.transform(accounts).withColumnRenamed("probability", "__p")
    return score_accounts(scored, F.col("__p"), row["best_threshold"]).drop("__p")
