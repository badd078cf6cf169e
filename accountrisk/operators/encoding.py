"""Target encoding with out-of-fold values for training rows."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accountrisk.session import written

ALL_ROWS = -1


def encoding_table(df: DataFrame, category: str, label: str, fold: str | None = None) -> DataFrame:
    """(category, fold, encoding): smoothed label means.

    Fold -1 uses every row; any other fold uses the rows outside it. Smoothing is empirical Bayes: the
    weight of a category's own mean is v / (v + w / n) with v the label variance over all rows used and
    w the variance within the category. The null category row of each fold holds its overall mean.
    One shuffle of (category, fold) sums; the out-of-fold sums are the difference from the total.
    """
    y = F.col(label).cast("double")
    fold_value = F.lit(ALL_ROWS) if fold is None else F.col(fold).cast("int")
    sums = df.groupBy(F.col(category).alias("category"), fold_value.alias("fold")).agg(
        F.count("*").alias("n"), F.sum(y).alias("s")
    )
    whole = sums.groupBy("category").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    whole = whole.select("category", F.lit(ALL_ROWS).alias("fold"), "n", "s")
    if fold is None:
        used = whole
    else:
        totals = whole.select("category", F.col("n").alias("cat_n"), F.col("s").alias("cat_s"))
        rest = sums.join(totals, "category").select(
            "category", "fold", (F.col("cat_n") - F.col("n")).alias("n"),
            (F.col("cat_s") - F.col("s")).alias("s"),
        )
        used = rest.unionByName(whole)

    # rows and label sum behind every fold: one row per fold and one for all rows
    overall = sums.agg(
        F.lit(ALL_ROWS).alias("fold"), F.sum("n").alias("rows"), F.sum("s").alias("hits")
    )
    if fold is not None:
        folds = Window.partitionBy()
        outside = sums.groupBy("fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).select(
            "fold",
            (F.sum("n").over(folds) - F.col("n")).alias("rows"),
            (F.sum("s").over(folds) - F.col("s")).alias("hits"),
        )
        overall = overall.unionByName(outside)
    base = F.try_divide(F.col("hits"), F.col("rows"))
    overall = overall.select("fold", base.alias("base"), (base * (1.0 - base)).alias("spread"))

    mean = F.try_divide(F.col("s"), F.col("n"))
    pull = F.col("spread") * F.col("n")
    weight = F.coalesce(F.try_divide(pull, pull + mean * (1.0 - mean)), F.lit(0.0))
    encoded = used.join(F.broadcast(overall), "fold").select(
        "category",
        "fold",
        F.coalesce(weight * mean + (1.0 - weight) * F.col("base"), F.col("base")).alias("encoding"),
    )
    return encoded.unionByName(
        overall.select(F.lit(None).cast("string").alias("category"), "fold", F.col("base").alias("encoding"))
    )


def encode(
    df: DataFrame, table: DataFrame, category: str, output: str, fold: str | None = None
) -> DataFrame:
    """Attach encodings; unseen categories get the overall mean."""
    defaults = {
        r["fold"]: r["encoding"] for r in table.where(F.col("category").isNull()).collect()
    }  # one row per fold
    seen = table.where(F.col("category").isNotNull())
    if fold is None:
        seen = seen.where(F.col("fold") == ALL_ROWS).drop("fold")
        keys, default = [category], F.lit(defaults[ALL_ROWS])
    else:
        seen = seen.withColumnRenamed("fold", fold)
        keys = [category, fold]
        default = F.element_at(
            F.create_map(*[F.lit(x) for item in defaults.items() for x in item]),
            F.col(fold).cast("int"),
        )
    lookup = seen.withColumnRenamed("category", category).withColumnRenamed("encoding", output)
    joined = df.join(lookup, keys, "left")  # Spark picks the strategy by size and splits hot categories
    return joined.withColumn(output, F.coalesce(F.col(output), default)).select(
        *df.columns, output
    )


class _EncoderParams(Params):
    inputCol = Param(Params._dummy(), "inputCol", "string column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "encoded column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    foldCol = Param(
        Params._dummy(), "foldCol", "fold number of training rows", TypeConverters.toString
    )

    def option(self, name: str) -> str:
        return self.getOrDefault(self.getParam(name))


class _TableWriter(MLWriter):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table.write.parquet(f"{path}/encodings")


class _TableReader(MLReader):
    def load(self, path):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TargetEncoderModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.table = self.sparkSession.read.parquet(f"{path}/encodings")
        return model


class TargetEncoderModel(Model, _EncoderParams, MLWritable, MLReadable):
    """Encodings as a table, written next to the model when it is saved.

    Rows that carry the fold column get the encoding learned outside their fold.
    """

    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self.table = table

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fold = self.option("foldCol")
        return encode(
            dataset, self.table, self.option("inputCol"), self.option("outputCol"),
            fold if fold in dataset.columns else None,
        )

    def write(self):
        return _TableWriter(self)

    @classmethod
    def read(cls):
        return _TableReader()


class TargetEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, labelCol="churn", foldCol="te_fold"):
        super().__init__()
        self._setDefault(labelCol="churn", foldCol="te_fold")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TargetEncoderModel:
        fold = self.option("foldCol")
        if fold not in dataset.columns:
            # without folds the rows would be encoded by their own labels
            raise ValueError(f"target encoding needs the fold column {fold!r}; build the pipeline with target_encoded")
        table = encoding_table(dataset, self.option("inputCol"), self.option("labelCol"), fold)
        model = TargetEncoderModel(written(table, "encodings"))
        for name in ("inputCol", "outputCol", "labelCol", "foldCol"):
            model._set(**{name: self.option(name)})
        return model
