"""Stratified splits and folds from a hash of the row id: no shuffle of rows, stable on retries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountrisk.functions.numeric import edges_reached
from accountrisk.operators.quantiles import exact_quantiles

HASH_DIGITS = 13  # hexadecimal digits: 52 bits, exact as a double
MAX_CLASSES = 1_000


def row_hash(row_id: str, seed: int) -> Column:
    """Leading digits of md5("seed:id") as a number; any engine with md5 gets the same."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double")


def class_share_rank(
    df: DataFrame, label: str, row_id: str, seed: int, shares: Sequence[float]
) -> Column:
    """How many of the rising ``shares`` a row's hash passes inside its own class.

    The cuts are quantiles of the hash within each class, so every class is divided in the same
    proportions up to one row. Classes are the values the label has, null among them, so every row has
    a rank. A label of more than MAX_CLASSES values is no class label and raises.
    """
    hashed = row_hash(row_id, seed)
    found = df.select(label).distinct().orderBy(label).limit(MAX_CLASSES + 1).collect()
    classes = [r[0] for r in found]
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values")

    def of(value) -> Column:
        return F.col(label).eqNullSafe(F.lit(value))

    per_class = df.select(*[F.when(of(c), hashed).alias(f"h{i}") for i, c in enumerate(classes)])
    cuts = exact_quantiles(per_class, per_class.columns, list(shares)) if classes else {}
    rank = F.lit(None).cast("int")
    for i, c in enumerate(classes):
        rank = F.when(of(c), edges_reached(hashed, cuts[f"h{i}"])).otherwise(rank)
    return rank


def train_test_split(
    df: DataFrame, label: str, row_id: str, test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    is_train = class_share_rank(df, label, row_id, seed, [test_share]) > 0
    return df.where(is_train), df.where(~is_train)


def with_folds(
    df: DataFrame, label: str, row_id: str, folds: int = 5, seed: int = 42, output: str = "fold"
) -> DataFrame:
    shares = [i / folds for i in range(1, folds)]
    return df.withColumn(output, class_share_rank(df, label, row_id, seed, shares))


def stratified_sample(
    df: DataFrame, label: str, row_id: str, share: float, seed: int = 42
) -> DataFrame:
    """Nested samples: a larger share of the same seed contains the smaller one."""
    if share >= 1.0:
        return df
    return df.where(class_share_rank(df, label, row_id, seed, [share]) == 0)
