"""Cross-fitted probability calibration: isotonic or sigmoid, averaged over folds."""

from __future__ import annotations

from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountrisk.operators.splits import with_folds
from accountrisk.operators.training import fit_pipeline
from accountrisk.session import written

SCORE = "__score"
CALIBRATED = "__calibrated"


#: Scores are rounded to so many digits before the isotonic fit: at most 1,000,001 of them, whatever the rows.
DIGITS = 6
#: Nodes of all members up to which their trees are scored in one plan.
PLAN_NODES = 500_000
#: Neighbouring score ranges that one task merges.
MERGED = 8
BLOCK = "low double, high double, hits double, weight double"


def score_tallies(df: DataFrame, label: str, score: str, digits: int = DIGITS) -> DataFrame:
    """(score, hits, weight) per distinct rounded score: equal scores are one weighted point."""
    at = F.bround(F.col(score).cast("double"), digits)
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return rows.groupBy(at.alias(SCORE)).agg(
        F.sum(F.col(label).cast("double")).alias("hits"), F.count("*").cast("double").alias("weight")
    )


def pool(blocks: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: blocks (low, high, hits, weight) by score, merged until their means rise.

    Sums stay sums, so pooling parts first and their blocks afterwards gives what pooling all points gives.
    """
    kept: list[list[float]] = []
    for low, high, hits, weight in blocks.tolist():
        while kept and kept[-1][2] * weight >= hits * kept[-1][3]:
            low, _, more_hits, more_weight = kept.pop()
            hits, weight = hits + more_hits, weight + more_weight
        kept.append([low, high, hits, weight])
    return np.array(kept, np.float64).reshape(-1, 4)


def pooled_blocks(tallies: DataFrame) -> DataFrame:
    """The blocks of the isotonic fit, a row each: (low, high, hits, weight).

    Score ranges are pooled where they lie, then neighbouring ranges are merged up a tree; a task holds the blocks
    of ``MERGED`` ranges, the last one those of all.
    """
    spark = tallies.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = ["low", "high", "hits", "weight"]

    def part_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [b for b in batches if len(b)]
        if rows:
            found = pd.DataFrame(pool(pd.concat(rows)[names].to_numpy()), columns=names)
            yield found.assign(part=TaskContext.get().partitionId())

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        found = pool(group.sort_values("low")[names].to_numpy())
        return pd.DataFrame(found, columns=names).assign(part=int(group["part"].iloc[0]) // MERGED)

    points = tallies.select(F.col(SCORE).alias("low"), F.col(SCORE).alias("high"), "hits", "weight")
    spread = points.repartitionByRange(parts, "low").sortWithinPartitions("low")
    blocks = written(spread.mapInPandas(part_of, BLOCK + ", part int"), "isotonic-blocks")
    while parts > 1:
        blocks = blocks.groupBy(F.expr(f"part DIV {MERGED}")).applyInPandas(merged, BLOCK + ", part int")
        parts = -(-parts // MERGED)
    return blocks.select(*names)


def fit_isotonic(df: DataFrame, label: str, score: str, digits: int = DIGITS) -> IsotonicRegressionModel:
    """Monotone step fit on grouped scores.

    The fit is done by :func:`pooled_blocks`; the model gets both ends of every block, so the driver holds blocks,
    of which there are no more than rounded scores.
    """
    blocks = pooled_blocks(score_tallies(df, label, score, digits))
    mean = (F.col("hits") / F.col("weight")).alias("__mean")
    ends = F.explode(F.array_distinct(F.array("low", "high"))).alias(SCORE)
    return IsotonicRegression(
        featuresCol=SCORE, labelCol="__mean", weightCol="weight", predictionCol=CALIBRATED
    ).fit(written(blocks.select(ends, mean, "weight"), "isotonic-steps"))


def calibrated_scores(df: DataFrame, label: str, score: str, digits: int = DIGITS) -> DataFrame:
    """(score, weight, calibrated) of every distinct score: the steps of the fit over the scores they cover."""
    tallies = written(score_tallies(df, label, score, digits), "score-tallies")
    model = fit_isotonic(df, label, score, digits)
    return model.transform(tallies).select(
        F.col(SCORE).alias("score"), F.col("weight").cast("bigint").alias("weight"), F.col(CALIBRATED).alias("calibrated")
    )


def fit_sigmoid(df: DataFrame, label: str, score: str) -> tuple[float, float]:
    """Slope and intercept of a logistic curve with Platt's smoothed targets.

    A target t is a weighted pair of rows: label 1 with weight t and label 0 with weight 1 - t.
    """
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    ).first()
    target = F.when(F.col(label) == 1, F.lit((counts["pos"] + 1) / (counts["pos"] + 2))).otherwise(
        F.lit(1 / (counts["neg"] + 2))
    )
    pairs = F.array(
        F.struct(F.lit(1.0).alias("y"), target.alias("w")),
        F.struct(F.lit(0.0).alias("y"), (1.0 - target).alias("w")),
    )
    rows = df.select(
        array_to_vector(F.array(F.col(score).cast("double"))).alias("x"), F.inline(pairs)
    )
    fitted = LogisticRegression(
        featuresCol="x", labelCol="y", weightCol="w", standardization=True
    ).fit(rows)
    return float(fitted.coefficients[0]), float(fitted.intercept)


def raw_score(method: str) -> Column:
    """Isotonic fits depend only on order; the sigmoid works on the classifier's raw margin."""
    column = "probability" if method == "isotonic" else "rawPrediction"
    return vector_to_array(column)[1]


class _EnsembleWriter(MLWriter):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        for i, (member, calibrator) in enumerate(self.model.members):
            member.write().save(f"{path}/member-{i}")
            if isinstance(calibrator, IsotonicRegressionModel):
                calibrator.write().save(f"{path}/calibrator-{i}")


class _EnsembleReader(MLReader):
    def load(self, path):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CalibratedEnsembleModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        lines = model.getOrDefault(model.sigmoids)
        for i in range(model.getOrDefault(model.size)):
            member = DefaultParamsReader.loadParamsInstance(f"{path}/member-{i}", self.sparkSession)
            calibrator = (
                tuple(lines[i]) if lines
                else IsotonicRegressionModel.load(f"{path}/calibrator-{i}")
            )
            model.members.append((member, calibrator))
        return model


class CalibratedEnsembleModel(Model, MLWritable, MLReadable):
    """Mean of the members' calibrated probabilities of class 1, as a plain double column."""

    outputCol = Param(
        Params._dummy(), "outputCol", "calibrated probability column", TypeConverters.toString
    )
    method = Param(Params._dummy(), "method", "isotonic or sigmoid", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "number of members", TypeConverters.toInt)
    sigmoids = Param(
        Params._dummy(), "sigmoids", "slope and intercept per member", TypeConverters.identity
    )

    def __init__(self, members=None, method="isotonic", outputCol="probability"):
        super().__init__()
        self.members = list(members or [])
        self._set(
            outputCol=outputCol,
            method=method,
            size=len(self.members),
            sigmoids=[list(c) for _, c in self.members if isinstance(c, tuple)],
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Spark puts a whole model into the tasks of a plan that uses it, so members of many nodes score one after another,
        each in a job of its own; streams keep one plan."""
        score = raw_score(self.getOrDefault(self.method))
        nodes = sum(getattr(stage, "totalNumNodes", 0) for member, _ in self.members for stage in member.stages[-1:])
        heavy = nodes > PLAN_NODES and not dataset.isStreaming
        out = dataset
        parts = []
        for i, (member, calibrator) in enumerate(self.members):
            scored = member.transform(out).withColumn(SCORE, score)
            if isinstance(calibrator, tuple):
                slope, intercept = calibrator
                z = F.lit(slope) * F.col(SCORE) + F.lit(intercept)
                scored = scored.withColumn(CALIBRATED, F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
            else:
                scored = calibrator.transform(scored)
            parts.append(f"__p{i}")
            out = scored.select(*out.columns, F.col(CALIBRATED).alias(parts[-1]))
            if heavy:
                out = written(out, "member-scores")
        mean = sum((F.col(p) for p in parts), F.lit(0.0)) / F.lit(float(len(parts)))
        return out.withColumn(self.getOrDefault(self.outputCol), mean).drop(*parts)

    def write(self):
        return _EnsembleWriter(self)

    @classmethod
    def read(cls):
        return _EnsembleReader()


def fit_calibrated(
    pipeline: Pipeline,
    train: DataFrame,
    label: str,
    row_id: str,
    method: str = "isotonic",
    folds: int = 5,
    seed: int = 42,
    digits: int = DIGITS,
) -> CalibratedEnsembleModel:
    """Per fold: fit the pipeline on the other folds and the calibrator on the fold left out; folds side by side."""
    if method not in ("isotonic", "sigmoid"):
        raise ValueError(f"unknown calibration method {method!r}")
    data = written(with_folds(train, label, row_id, folds, seed, "__fold"), "calibration")

    def one(fold: int) -> tuple:
        member = fit_pipeline(pipeline, data.where(F.col("__fold") != fold).drop("__fold"))
        held_out = written(
            member.transform(data.where(F.col("__fold") == fold).drop("__fold")).select(
                F.col(label), raw_score(method).alias(SCORE)
            ),
            "held-out",
        )
        if method == "isotonic":
            calibrator = fit_isotonic(held_out, label, SCORE, digits)
        else:
            calibrator = fit_sigmoid(held_out, label, SCORE)
        return member, calibrator

    with ThreadPool(folds) as pool_:
        members = pool_.map(inheritable_thread_target(data.sparkSession)(one), range(folds))
    return CalibratedEnsembleModel(members, method)
