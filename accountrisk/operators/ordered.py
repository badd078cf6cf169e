"""Running totals over a sorted column without a global window.

Rows are first reduced to distinct values with their counts, so a value shared by a third of all rows
is one row. Range buckets come from a mergeable sketch; they only balance the work and never change a
result. Totals per bucket (keys x buckets rows) give each bucket its starting offset, and the running
sum inside a bucket is an ordinary partitioned window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "bucket"
MAX_BUCKETS = 10_000


def default_buckets(df: DataFrame) -> int:
    """One bucket per shuffle partition: the cluster's own measure of how far to split."""
    setting = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, min(setting, MAX_BUCKETS))


def range_splits(
    df: DataFrame, columns: Sequence[str], buckets: int | None = None
) -> dict[str, list[float]]:
    """Approximate equal-count split points per column, ends open.

    Collected once (columns x buckets numbers) and used as constants, so that a retried task sees the
    same buckets as the first attempt.
    """
    buckets = buckets or default_buckets(df)
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    accuracy = max(1_000, 10 * buckets)
    found = df.agg(
        *[F.percentile_approx(c, probs, accuracy).alias(f"s{i}") for i, c in enumerate(columns)]
    ).first()
    return {
        c: [-math.inf, *sorted(set(found[f"s{i}"] or [0.0])), math.inf]
        for i, c in enumerate(columns)
    }


def with_range_bucket(
    df: DataFrame, columns: Sequence[str], splits: dict[str, list[float]], suffix: str
) -> DataFrame:
    """Add ``column + suffix``: index of the half-open range holding the value (binary search)."""
    return Bucketizer(
        inputCols=list(columns),
        outputCols=[c + suffix for c in columns],
        splitsArray=[splits[c] for c in columns],
        handleInvalid="keep",
    ).transform(df)


def distinct_tallies(
    df: DataFrame, keys: Sequence[str], value: str, measures: dict[str, Column],
    buckets: int | None = None,
) -> DataFrame:
    """(keys, bucket, value, measures): one row per distinct value, nulls left out."""
    present = df.where(F.col(value).isNotNull())
    splits = range_splits(present, [value], buckets)
    bucketed = with_range_bucket(present, [value], splits, "__bucket")
    return bucketed.groupBy(
        *keys, F.col(f"{value}__bucket").cast("int").alias(BUCKET), value
    ).agg(*[m.alias(name) for name, m in measures.items()])


def running_totals(
    tallies: DataFrame, keys: Sequence[str], value: str, measures: Sequence[str]
) -> DataFrame:
    """Add ``m_before`` (sum over smaller values), ``m_total`` per key and ``next_value``."""
    keys = list(keys)
    per_bucket = tallies.groupBy(*keys, BUCKET).agg(
        F.min(value).alias("__first"), *[F.sum(m).alias(f"__{m}") for m in measures]
    )
    # at most MAX_BUCKETS rows per key
    by_bucket = Window.partitionBy(*keys).orderBy(BUCKET)
    earlier = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = per_bucket.select(
        *keys,
        BUCKET,
        F.lead("__first").over(by_bucket).alias("__next_first"),
        *[
            F.coalesce(F.sum(f"__{m}").over(earlier), F.lit(0)).alias(f"__{m}_offset")
            for m in measures
        ],
        *[F.sum(f"__{m}").over(whole).alias(f"{m}_total") for m in measures],
    )
    inside = Window.partitionBy(*keys, BUCKET).orderBy(value)
    smaller = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = tallies.withColumns(
        {
            **{
                f"__{m}_local": F.coalesce(F.sum(m).over(smaller), F.lit(0)) for m in measures
            },
            "__next_local": F.lead(value).over(inside),
        }
    )
    # Same partitioning as the window above, so only the small offsets table moves. Every bucket has
    # its offsets; a left join adds no null filter below the tallies, so both uses share one shuffle.
    joined = local.join(offsets, [*keys, BUCKET], "left")
    return joined.select(
        *keys,
        value,
        *measures,
        *[(F.col(f"__{m}_local") + F.col(f"__{m}_offset")).alias(f"{m}_before") for m in measures],
        *[f"{m}_total" for m in measures],
        F.coalesce("__next_local", "__next_first").alias("next_value"),
    )
