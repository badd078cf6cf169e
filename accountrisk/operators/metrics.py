"""Model metrics over (label, score) rows: benefit, curve, ranking and calibration error."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountrisk.functions.numeric import edges_reached, rounded
from accountrisk.operators.ordered import distinct_tallies, running_totals
from accountrisk.operators.quantiles import exact_quantiles
from accountrisk.schema import BusinessTerms


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y, hit = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(y & hit).alias("tp"),
        F.count_if(~y & hit).alias("fp"),
        F.count_if(y & ~hit).alias("fn"),
        F.count_if(~y & ~hit).alias("tn"),
    )


def net_benefit(
    label: Column, prediction: Column, ltv: Column | None = None,
    terms: BusinessTerms = BusinessTerms(),
) -> Column:
    """Aggregate: money saved by true alarms minus wasted campaigns and lost accounts."""
    value = F.lit(terms.default_mrr * terms.ltv_multiplier) if ltv is None else ltv
    cost = F.lit(terms.intervention_cost)
    per_row = (
        F.when((label == 1) & (prediction == 1), F.lit(terms.success_rate) * value - cost)
        .when((label == 0) & (prediction == 1), -cost)
        .when((label == 1) & (prediction == 0), -value)
        .otherwise(F.lit(0.0))
    )
    return F.coalesce(F.sum(per_row), F.lit(0.0))


def default_thresholds() -> list[float]:
    """91 evenly spaced cut-offs from 0.05 to 0.95."""
    step = (0.95 - 0.05) / 90
    return [0.05 + i * step for i in range(90)] + [0.95]


def financial_curve(
    df: DataFrame,
    label: str,
    probability: str,
    mrr: str | None = None,
    thresholds: Sequence[float] | None = None,
    terms: BusinessTerms = BusinessTerms(),
) -> DataFrame:
    """Benefit, TP, FP and FN at every threshold from one pass over the rows.

    A row counts towards all thresholds it reaches, so rows are reduced to one tally per number of
    thresholds reached and the curve is a suffix sum over that short table.
    """
    cuts = list(default_thresholds() if thresholds is None else thresholds)
    if cuts != sorted(set(cuts)):
        raise ValueError("thresholds must rise strictly")
    spark = df.sparkSession
    revenue = F.lit(terms.default_mrr) if mrr is None else F.col(mrr)
    rows = df.select(
        F.col(label).alias("y"),
        F.col(probability).cast("double").alias("p"),
        (revenue * F.lit(terms.ltv_multiplier)).alias("ltv"),
    ).where(F.col("p").isNotNull())
    reached = Bucketizer(
        inputCol="p", outputCol="reached", splits=[-math.inf, *cuts, math.inf]
    ).transform(rows)
    churned = F.col("y") == 1
    tally = reached.groupBy(F.col("reached").cast("int").alias("reached")).agg(
        F.count_if(churned).alias("n_pos"),
        F.count_if(~churned).alias("n_neg"),
        F.sum(F.when(churned, F.col("ltv")).otherwise(F.lit(0.0))).alias("ltv_pos"),
    )
    # one row per possible value of "reached": a fixed short table
    grid = spark.createDataFrame(
        [(i, cuts[i - 1] if i else None) for i in range(len(cuts) + 1)],
        "reached int, threshold double",
    )
    filled = grid.join(tally, "reached", "left").fillna(0, ["n_pos", "n_neg", "ltv_pos"])
    upwards = Window.orderBy("reached").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    below = Window.orderBy("reached").rowsBetween(Window.unboundedPreceding, -1)
    summed = filled.select(
        (F.col("reached") - 1).alias("position"),
        "threshold",
        F.sum("n_pos").over(upwards).alias("tp"),
        F.sum("n_neg").over(upwards).alias("fp"),
        F.coalesce(F.sum("n_pos").over(below), F.lit(0)).alias("fn"),
        F.sum("ltv_pos").over(upwards).alias("ltv_tp"),
        F.coalesce(F.sum("ltv_pos").over(below), F.lit(0.0)).alias("ltv_fn"),
    ).where(F.col("threshold").isNotNull())
    benefit = (
        F.lit(terms.success_rate) * F.col("ltv_tp")
        - F.lit(terms.intervention_cost) * (F.col("tp") + F.col("fp"))
        - F.col("ltv_fn")
    )
    return summed.select(
        "position", "threshold", "tp", "fp", "fn", rounded(benefit, 2).alias("net_benefit_usd")
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """First maximum of the curve: the lowest threshold wins ties."""
    best = F.max_by(
        F.struct("threshold", "net_benefit_usd", "tp", "fp", "fn"),
        F.struct(F.col("net_benefit_usd"), -F.col("position")),
    )
    return curve.agg(best.alias("best")).select(
        F.col("best.threshold").alias("best_threshold"),
        F.col("best.net_benefit_usd").alias("max_net_benefit_usd"),
        F.col("best.tp").alias("tps_at_best"),
        F.col("best.fp").alias("fps_at_best"),
        F.col("best.fn").alias("fns_at_best"),
    )


def brier(label: Column, probability: Column) -> Column:
    return F.avg((probability - label) * (probability - label))


def uniform_edges(n_bins: int) -> list[float]:
    """Edges of equal-width bins on [0, 1], as floating multiples of the width."""
    step = 1.0 / n_bins
    return [i * step for i in range(n_bins)] + [1.0]


def _bin_table(df: DataFrame, label: str, probability: str, bin_index: Column) -> DataFrame:
    rows = df.where(F.col(probability).isNotNull())
    return rows.groupBy(bin_index.alias("bin")).agg(
        F.count("*").alias("n"),
        F.sum(F.col(label).cast("double")).alias("sum_label"),
        F.sum(probability).alias("sum_probability"),
    )


def calibration_error(
    df: DataFrame, label: str, probability: str, n_bins: int = 10
) -> DataFrame:
    """Expected calibration error: bins [a, b), the last one closed."""
    inner = uniform_edges(n_bins)[1:-1]
    bins = _bin_table(df, label, probability, edges_reached(F.col(probability), inner))
    gap = F.abs(F.col("sum_label") - F.col("sum_probability"))
    return bins.agg((F.sum(gap) / F.sum("n")).alias("ece"))


def reliability_curve(
    df: DataFrame, label: str, probability: str, n_bins: int = 10, strategy: str = "uniform"
) -> DataFrame:
    """Mean label and mean probability per non-empty bin; inner edges belong to the lower bin."""
    edges = uniform_edges(n_bins)
    if strategy == "quantile":
        edges = exact_quantiles(df, [probability], edges)[probability]
    elif strategy != "uniform":
        raise ValueError(f"unknown strategy {strategy!r}")
    index = edges_reached(F.col(probability), [e for e in edges[1:-1] if e is not None], False)
    return _bin_table(df, label, probability, index).select(
        "bin",
        "n",
        (F.col("sum_label") / F.col("n")).alias("prob_true"),
        (F.col("sum_probability") / F.col("n")).alias("prob_pred"),
    )


def score_ranks(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Positives and negatives per distinct score with the counts below it."""
    positive = F.col(label) == 1
    tallies = distinct_tallies(
        df,
        keys,
        score,
        {"pos": F.count_if(positive), "neg": F.count_if(~positive)},
        buckets,
    )
    return running_totals(tallies, keys, score, ["pos", "neg"])


def ranking_metrics(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Exact ROC-AUC (ties count half) and average precision (step sum), per key if keys are given.

    Both are null when a class is absent.
    """
    ranks = score_ranks(df, label, score, keys, buckets)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    all_pos, all_neg = F.col("pos_total").cast("double"), F.col("neg_total").cast("double")
    wins = F.sum(pos * (F.col("neg_before") + neg / 2.0))
    tp = all_pos - F.col("pos_before")
    fp = all_neg - F.col("neg_before")
    return ranks.groupBy(*keys).agg(
        F.try_divide(wins, F.max(all_pos) * F.max(all_neg)).alias("roc_auc"),
        F.try_divide(F.sum(pos * F.try_divide(tp, tp + fp)), F.max(all_pos)).alias("pr_auc"),
    )


def f1_score(label: Column, prediction: Column) -> Column:
    """Aggregate: F1 of the positive class, 0 when undefined."""
    tp = F.count_if((label == 1) & (prediction == 1))
    wrong = F.count_if(label != prediction)
    return F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + wrong), F.lit(0.0))


#: A metric by name, or a function (scored rows, label, probability, keys, value column) to (keys, metric).
Metric = str | Callable[[DataFrame, str, str, Sequence[str], str | None], DataFrame]
METRICS = ("roc_auc", "pr_auc", "f1", "net_benefit", "brier")


def keyed_metric(
    df: DataFrame, metric: Metric, label: str, probability: str, keys: Sequence[str] = (), value: str | None = None,
    threshold: float = 0.5, terms: BusinessTerms = BusinessTerms(),
) -> DataFrame:
    """(keys, metric) of scored rows, larger is better: the Brier score is negated.

    F1 and net benefit judge the rows at ``threshold``; ``value`` is the column of monthly revenue for net benefit, the
    default revenue without it.
    """
    if callable(metric):
        return metric(df, label, probability, keys, value)
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    if metric in ("roc_auc", "pr_auc"):
        return ranking_metrics(df, label, probability, keys).select(*keys, F.col(metric).alias("metric"))
    y, p = F.col(label), F.col(probability)
    hit = (p >= threshold).cast("int")
    ltv = None if value is None else F.col(value) * F.lit(terms.ltv_multiplier)
    found = {"f1": lambda: f1_score(y, hit), "net_benefit": lambda: net_benefit(y, hit, ltv, terms), "brier": lambda: -brier(y, p)}
    return df.groupBy(*keys).agg(found[metric]().alias("metric"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (2 n_class), one row per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_class"))
    both = Window.partitionBy()  # one row per class
    return counts.withColumn(
        "weight", F.sum("n_class").over(both) / (F.count("*").over(both) * F.col("n_class"))
    )


def positive_probability(df: DataFrame, column: str) -> Column:
    """Probability of class 1 from a vector or a plain number column."""
    if isinstance(df.schema[column].dataType, VectorUDT):
        return vector_to_array(column)[1]
    return F.col(column).cast("double")


class NetBenefitEvaluator(Evaluator, DefaultParamsReadable, DefaultParamsWritable):
    """Net financial benefit as a model-selection metric for Spark ML tuning."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    predictionCol = Param(
        Params._dummy(), "predictionCol", "0/1 prediction column", TypeConverters.toString
    )
    ltvCol = Param(
        Params._dummy(), "ltvCol", "account value column; empty for the default value",
        TypeConverters.toString,
    )
    interventionCost = Param(
        Params._dummy(), "interventionCost", "cost of one campaign", TypeConverters.toFloat
    )
    successRate = Param(
        Params._dummy(), "successRate", "share of campaigns that work", TypeConverters.toFloat
    )
    defaultLtv = Param(
        Params._dummy(), "defaultLtv", "account value without ltvCol", TypeConverters.toFloat
    )

    @keyword_only
    def __init__(
        self, *, labelCol="churn", predictionCol="prediction", ltvCol="",
        interventionCost=150.0, successRate=0.65, defaultLtv=10200.0,
    ):
        super().__init__()
        self._setDefault(
            labelCol="churn", predictionCol="prediction", ltvCol="",
            interventionCost=150.0, successRate=0.65, defaultLtv=10200.0,
        )
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        terms = BusinessTerms(
            self.getOrDefault(self.interventionCost),
            self.getOrDefault(self.successRate),
            1.0,
            self.getOrDefault(self.defaultLtv),
        )
        ltv = self.getOrDefault(self.ltvCol)
        return dataset.agg(
            net_benefit(
                F.col(self.getOrDefault(self.labelCol)),
                F.col(self.getOrDefault(self.predictionCol)),
                F.col(ltv) if ltv else None,
                terms,
            )
        ).first()[0]

    def isLargerBetter(self) -> bool:
        return True
