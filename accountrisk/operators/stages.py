"""Spark ML stages of the leak-free preprocessor.

The single steps can be used alone; ``NumericPreparation`` learns the whole numeric chain in one go.

Numeric work happens on copies named ``num__<column>`` and categorical work on ``cat__<column>``, so the
account columns stay as they came and can be reported next to the score.
"""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountrisk.functions.numeric import clip, number
from accountrisk.functions.ratios import EPSILON, require_columns, with_ratios
from accountrisk.operators.encoding import TargetEncoder
from accountrisk.operators.quantiles import (
    between,
    exact_quantiles,
    order_statistics,
    rank_pair,
)
from accountrisk.operators.splits import with_folds
from accountrisk.schema import ID_COLUMN, RATIO_FEATURES, RATIO_INPUTS, TARGET_COLUMN

MISSING = "missing"


class _Columns(Params):
    inputCols = Param(
        Params._dummy(), "inputCols", "columns the stage works on", TypeConverters.toListString
    )

    def columns(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class _Persistent(DefaultParamsReadable, DefaultParamsWritable):
    pass


class RatioFeatures(Transformer, _Persistent):
    """Adds the four account ratios."""

    epsilon = Param(Params._dummy(), "epsilon", "added to denominators", TypeConverters.toFloat)
    dropIntermediates = Param(
        Params._dummy(), "dropIntermediates", "drop the raw inputs", TypeConverters.toBoolean
    )

    @keyword_only
    def __init__(self, *, epsilon=EPSILON, dropIntermediates=False):
        super().__init__()
        self._setDefault(epsilon=EPSILON, dropIntermediates=False)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        require_columns(dataset, RATIO_INPUTS)
        return with_ratios(
            dataset, self.getOrDefault(self.epsilon), self.getOrDefault(self.dropIntermediates)
        )


class NumericCopies(Transformer, _Columns, _Persistent):
    """``num__c`` as double with NaN as null."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        require_columns(dataset, self.columns())
        return dataset.withColumns({f"num__{c}": number(c) for c in self.columns()})


class CategoryCopies(Transformer, _Columns, _Persistent):
    """``cat__c`` as string, nulls as their own category."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        require_columns(dataset, self.columns())
        return dataset.withColumns(
            {
                f"cat__{c}": F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
                for c in self.columns()
            }
        )


class Log1p(Transformer, _Columns, _Persistent):
    """log(1 + x) of the non-negative part; nulls count as zero."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({c: log1p_of(c) for c in self.columns() if c in dataset.columns})


def log1p_of(column: str) -> Column:
    return F.log1p(F.greatest(F.coalesce(number(column), F.lit(0.0)), F.lit(0.0)))


class _FittedColumns(Model, _Columns, _Persistent):
    """Model whose state is a short list of numbers per column."""

    values = Param(
        Params._dummy(), "values", "learned numbers per column", TypeConverters.identity
    )

    @keyword_only
    def __init__(self, *, inputCols=None, values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def learned(self) -> dict[str, list[float]]:
        return self.getOrDefault(self.values)

    def apply(self, column: str, numbers: list[float]) -> Column:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(
            {
                c: self.apply(c, numbers)
                for c, numbers in self.learned().items()
                if c in dataset.columns
            }
        )


class _ColumnsEstimator(Estimator, _Columns, _Persistent):
    def fitted(self, model: type[_FittedColumns], values: dict[str, list[float]]):
        return self._copyValues(model(inputCols=self.columns(), values=values))


class MedianImputerModel(_FittedColumns):
    def apply(self, column, numbers):
        return F.coalesce(number(column), F.lit(numbers[0]))


class MedianImputer(_ColumnsEstimator):
    """Nulls become the exact median; a column without any value becomes zero."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        found = exact_quantiles(dataset, self.columns(), [0.5])
        return self.fitted(
            MedianImputerModel, {c: [0.0 if q[0] is None else q[0]] for c, q in found.items()}
        )


class WinsorizerModel(_FittedColumns):
    def apply(self, column, numbers):
        return clip(number(column), *numbers)


class Winsorizer(_ColumnsEstimator):
    """Clips each column to quantiles learned at fit; nulls stay null."""

    lower = Param(Params._dummy(), "lower", "lower quantile", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper quantile", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, lower=0.01, upper=0.99):
        super().__init__()
        self._setDefault(lower=0.01, upper=0.99)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> WinsorizerModel:
        probs = [self.getOrDefault(self.lower), self.getOrDefault(self.upper)]
        found = exact_quantiles(dataset, self.columns(), probs)
        return self.fitted(
            WinsorizerModel, {c: q for c, q in found.items() if q[0] is not None}
        )


class ScalerModel(_FittedColumns):
    """(x - centre) / scale."""

    def apply(self, column, numbers):
        centre, scale = numbers
        return (number(column) - F.lit(centre)) / F.lit(scale)


class RobustColumnScaler(_ColumnsEstimator):
    """Centre on the exact median, scale by the exact interquartile range (1 where that is zero)."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ScalerModel:
        found = exact_quantiles(dataset, self.columns(), [0.25, 0.5, 0.75])
        return self.fitted(
            ScalerModel,
            {c: [q[1], (q[2] - q[0]) or 1.0] for c, q in found.items() if q[0] is not None},
        )


class StandardColumnScaler(_ColumnsEstimator):
    """Centre on the mean, scale by the population deviation (1 where that is zero)."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ScalerModel:
        cols = self.columns()
        row = dataset.agg(
            *[F.avg(number(c)).alias(f"m{i}") for i, c in enumerate(cols)],
            *[F.stddev_pop(number(c)).alias(f"s{i}") for i, c in enumerate(cols)],
        ).first()
        return self.fitted(
            ScalerModel,
            {
                c: [row[f"m{i}"], row[f"s{i}"] or 1.0]
                for i, c in enumerate(cols)
                if row[f"m{i}"] is not None
            },
        )


class NumericPreparationModel(_FittedColumns):
    """Fill, clip, log and scale as one expression per column."""

    logged = Param(
        Params._dummy(), "logged", "columns that take the log step", TypeConverters.toListString
    )

    def apply(self, column, numbers):
        fill, lower, upper, centre, scale = numbers
        value = clip(F.coalesce(number(column), F.lit(fill)), lower, upper)
        if column in self.getOrDefault(self.logged):
            value = F.log1p(F.greatest(value, F.lit(0.0)))
        return (value - F.lit(centre)) / F.lit(scale)


class NumericPreparation(_ColumnsEstimator):
    """Median fill, winsorizing, log1p and scaling learned from one set of order statistics.

    Every step keeps the order of values and the fill adds copies of the median, so each quantile the
    chain needs, before or after any step, is a transformed pair of raw order statistics. Learning the
    four steps together therefore costs one selection instead of three; the numbers equal those of the
    separate stages.
    """

    lower = Param(Params._dummy(), "lower", "lower quantile", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper quantile", TypeConverters.toFloat)
    winsorize = Param(
        Params._dummy(), "winsorize", "clip to the quantiles", TypeConverters.toBoolean
    )
    logged = Param(
        Params._dummy(), "logged", "columns that take the log step", TypeConverters.toListString
    )
    scaler = Param(Params._dummy(), "scaler", "robust or standard", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, inputCols=None, lower=0.01, upper=0.99, winsorize=True, logged=None,
        scaler="robust",
    ):
        super().__init__()
        self._setDefault(lower=0.01, upper=0.99, winsorize=True, logged=[], scaler="robust")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> NumericPreparationModel:
        bounds = [self.getOrDefault(self.lower), self.getOrDefault(self.upper)]
        quartiles = [0.25, 0.5, 0.75]

        def raw_rank(rank: int, values: int, rows: int) -> int | None:
            """Raw rank behind a rank of the filled column; None where it is the median fill."""
            middle, filled = (values - 1) // 2, rows - values
            if rank <= middle:
                return rank
            return None if rank <= middle + filled else rank - filled

        def ranks(values: int, rows: int) -> list[int]:
            wanted = list(rank_pair(0.5, values)[:2])
            for p in bounds + quartiles:
                wanted += [raw_rank(r, values, rows) for r in rank_pair(p, rows)[:2]]
            return [r for r in wanted if r is not None]

        rows, counts, at_rank = order_statistics(dataset, self.columns(), ranks)
        learned = {}
        for c in self.columns():
            n = counts[c]
            if n == 0:
                learned[c] = [0.0, 0.0, 0.0, 0.0, 1.0]
                continue
            low, high, share = rank_pair(0.5, n)
            fill = between(at_rank[(c, low)], at_rank[(c, high)], share)

            def quantile(p, step=lambda v: v, c=c, n=n, fill=fill):
                a, b, part = rank_pair(p, rows)
                values = [
                    fill if r is None else at_rank[(c, r)]
                    for r in (raw_rank(a, n, rows), raw_rank(b, n, rows))
                ]
                return between(step(values[0]), step(values[1]), part)

            lower, upper = (
                (quantile(bounds[0]), quantile(bounds[1]))
                if self.getOrDefault(self.winsorize)
                else (-math.inf, math.inf)
            )

            def shaped(v, c=c, lower=lower, upper=upper):
                v = min(max(v, lower), upper)
                return math.log1p(max(v, 0.0)) if c in self.getOrDefault(self.logged) else v

            q1, q2, q3 = (quantile(p, shaped) for p in quartiles)
            learned[c] = [fill, lower, upper, q2, (q3 - q1) or 1.0]
        logged = [c for c in self.columns() if c in self.getOrDefault(self.logged)]
        if self.getOrDefault(self.scaler) == "standard":
            unscaled = {c: [*v[:3], 0.0, 1.0] for c, v in learned.items()}
            shape = NumericPreparationModel(inputCols=self.columns(), values=unscaled)
            shape._set(logged=logged)
            moments = StandardColumnScaler(inputCols=self.columns()).fit(shape.transform(dataset))
            for c, (mean, deviation) in moments.learned().items():
                learned[c][3:] = [mean, deviation]
        model = NumericPreparationModel(inputCols=self.columns(), values=learned)
        return model._set(logged=logged)


class OneHotModel(_FittedColumns):
    """``<column>__hot`` sparse vectors; categories not seen at fit are all zeros.

    Categories are looked up in the indexer's table, so the plan does not grow with them.
    """

    def kept(self, column: str) -> list[str]:
        categories = self.learned()[column]
        return categories[1:] if len(categories) == 2 else categories

    def feature_names(self) -> list[str]:
        return [f"{c}={k}" for c in self.columns() for k in self.kept(c)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.columns()
        text, index = ([f"{c}__{kind}" for c in cols] for kind in ("text", "index"))
        out = dataset.withColumns({t: F.col(c).cast("string") for c, t in zip(cols, text, strict=True)})
        for c, t, i in zip(cols, text, index, strict=True):
            # a column that had no value keeps one slot that is always empty
            labels = self.kept(c) or [""]
            out = StringIndexerModel.from_labels(labels, t, outputCol=i, handleInvalid="keep").transform(out)
        # the extra index of unseen categories is the one that is dropped; sizes come with the column, so no job runs
        encoder = OneHotEncoder(inputCols=index, outputCols=[f"{c}__hot" for c in cols], dropLast=True)
        return encoder.fit(out).transform(out).drop(*text, *index)


class OneHot(_ColumnsEstimator):
    """One indicator per category in sorted order; a two-valued column keeps only the second."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> OneHotModel:
        cols = self.columns()
        pairs = F.array(
            *[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("k")) for c in cols]
        )
        found = dataset.select(F.inline(pairs)).where(F.col("k").isNotNull()).distinct()
        categories: dict[str, list[str]] = {c: [] for c in cols}
        for row in found.collect():  # the vocabulary itself
            categories[row["c"]].append(row["k"])
        return self.fitted(OneHotModel, {c: sorted(v) for c, v in categories.items()})


def preprocessor_stages(
    numeric: list[str],
    categorical: list[str],
    target_encoded: list[str] | None = None,
    winsorize: bool = True,
    log_transform: bool = True,
    log_features: list[str] | None = None,
    scaler: str = "robust",
    label: str = "churn",
    output: str = "features",
) -> list:
    """Ratios, then numeric chain beside one-hot (and optional target encoding), assembled.

    ``log_features`` limits the log step; by default it takes every numeric column.
    """
    if scaler not in ("robust", "standard"):
        raise ValueError(f"unknown scaler {scaler!r}")
    all_numeric = [*numeric, *RATIO_FEATURES]
    num = [f"num__{c}" for c in all_numeric]
    logged = num if log_features is None else [f"num__{c}" for c in log_features]
    stages: list = [
        RatioFeatures(),
        NumericCopies(inputCols=all_numeric),
        NumericPreparation(
            inputCols=num,
            winsorize=winsorize,
            logged=logged if log_transform else [],
            scaler=scaler,
        ),
    ]
    assembled = list(num)
    if categorical:
        cat = [f"cat__{c}" for c in categorical]
        stages += [CategoryCopies(inputCols=list(categorical)), OneHot(inputCols=cat)]
        assembled += [f"{c}__hot" for c in cat]
    if target_encoded:
        stages.append(CategoryCopies(inputCols=list(target_encoded)))
        for c in target_encoded:
            stages.append(
                TargetEncoder(inputCol=f"cat__{c}", outputCol=f"te__{c}", labelCol=label)
            )
            assembled.append(f"te__{c}")
    stages.append(VectorAssembler(inputCols=assembled, outputCol=output, handleInvalid="error"))
    return stages


FOLD_COLUMN = "te_fold"


class CrossFitPipeline(Pipeline):
    """A pipeline that gives the rows it is fitted on stratified folds.

    Target encoders see the folds while the pipeline is fitted: what later stages train on are values learned
    outside each row's fold. Rows scored later carry no fold and get the values of all rows.
    """

    def __init__(self, stages, label: str, row_id: str, folds: int = 5, seed: int = 42):
        super().__init__(stages=stages)
        self.label, self.row_id, self.folds, self.seed = label, row_id, folds, seed

    def folded(self, dataset: DataFrame) -> DataFrame:
        if FOLD_COLUMN in dataset.columns:
            return dataset
        return with_folds(dataset, self.label, self.row_id, self.folds, self.seed, FOLD_COLUMN)

    def _fit(self, dataset: DataFrame):
        return super()._fit(self.folded(dataset))


def pipeline_of(stages: list, target_encoded=(), label: str = TARGET_COLUMN, row_id: str = ID_COLUMN) -> Pipeline:
    """A pipeline of the stages, cross-fitted where something is target-encoded."""
    return CrossFitPipeline(stages, label, row_id) if target_encoded else Pipeline(stages=stages)


def build_preprocessor(
    numeric, categorical, target_encoded=(), label: str = TARGET_COLUMN, row_id: str = ID_COLUMN, **options
) -> Pipeline:
    stages = preprocessor_stages(numeric, categorical, target_encoded=target_encoded, label=label, **options)
    return pipeline_of(stages, target_encoded, label, row_id)


def build_full(preprocessor: Pipeline, classifier) -> Pipeline:
    """Preprocessor followed by any Spark ML classifier; folds stay as the preprocessor has them."""
    return preprocessor.copy().setStages([*preprocessor.getStages(), classifier])
