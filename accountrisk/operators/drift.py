"""Distribution drift between a reference and a current batch.

Both batches travel as one tagged table in long (feature, value) form. All numeric features share the
same passes: reference quantiles, bin counts, and the distinct-value table behind KS and Wasserstein.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountrisk.functions.numeric import edges_reached, number, rounded
from accountrisk.operators.ordered import (
    BUCKET,
    range_splits,
    running_totals,
    with_range_bucket,
)
from accountrisk.operators.quantiles import exact_quantiles

EPSILON = 1e-4
DRIFT_PSI = 0.25
WARNING_PSI = 0.10
KS_ALPHA = 0.05
KS_DISTANCE = 0.15
IS_REFERENCE = "is_reference"


# --- batches ----------------------------------------------------------------------------------------


def _tagged(reference: DataFrame, current: DataFrame, columns: dict[str, Column]) -> DataFrame:
    pick = [c.alias(name) for name, c in columns.items()]
    return reference.select(*pick, F.lit(True).alias(IS_REFERENCE)).unionByName(
        current.select(*pick, F.lit(False).alias(IS_REFERENCE))
    )


def tagged_numbers(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    return _tagged(reference, current, {f: number(f) for f in features})


def tagged_categories(
    reference: DataFrame, current: DataFrame, features: Sequence[str]
) -> DataFrame:
    return _tagged(reference, current, {f: F.col(f).cast("string") for f in features})


def _long(df: DataFrame, features: Sequence[str], kept: Sequence[str], **fields) -> DataFrame:
    """One row per (row, feature); ``fields`` map an output name to feature -> column."""
    entries = [
        F.struct(F.lit(f).alias("feature"), *[fn(f).alias(name) for name, fn in fields.items()])
        for f in features
    ]
    return df.select(*kept, F.inline(F.array(*entries)))


# --- profiles ---------------------------------------------------------------------------------------

PROFILE_PROBS = {
    "p01": 0.01, "p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99,
}


def numeric_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean, sample deviation, extremes and quantiles per feature; empty features are left out."""
    features = [f for f in features if f in df.columns]
    moments = df.agg(
        *[
            F.struct(
                F.avg(number(f)).alias("mean"),
                F.stddev_samp(number(f)).alias("std"),
                F.min(number(f)).alias("min"),
                F.max(number(f)).alias("max"),
            ).alias(f)
            for f in features
        ]
    ).first()
    quantiles = exact_quantiles(df, features, list(PROFILE_PROBS.values()))
    rows = []
    for f in features:
        if quantiles[f][0] is None:
            continue
        m, named = moments[f], dict(zip(PROFILE_PROBS, quantiles[f], strict=True))
        rows.append((f, m["mean"], m["std"], m["min"], m["max"], named["p50"], *named.values()))
    schema = ", ".join(
        ["feature string", *[f"{n} double" for n in ("mean", "std", "min", "max", "median")],
         *[f"{n} double" for n in PROFILE_PROBS]]
    )
    return df.sparkSession.createDataFrame(rows, schema)


def categorical_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Share of each category and the number of distinct ones, nulls left out."""
    features = [f for f in features if f in df.columns]
    counts = (
        _long(df, features, [], category=lambda f: F.col(f).cast("string"))
        .where(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("feature").agg(
        F.sum("n").alias("total"), F.count("*").alias("unique_count")
    )
    return counts.join(F.broadcast(totals), "feature").select(  # one row per feature
        "feature", "category", "n", (F.col("n") / F.col("total")).alias("proportion"),
        "unique_count",
    )


def baseline_header(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_samples")).withColumn(
        "extracted_at", F.current_timestamp()
    )


# --- population stability index ---------------------------------------------------------------------


def bin_edges(
    reference: DataFrame, features: Sequence[str], n_bins: int = 10
) -> dict[str, list[float]]:
    """Distinct reference quantiles per feature; empty for a feature without values."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    found = exact_quantiles(reference, features, probs)
    return {f: sorted({e for e in q if e is not None}) for f, q in found.items()}


def value_bin(feature: str, edges: Sequence[float]) -> Column:
    """Bin [a, b) of a value; the outer bins are open-ended."""
    return edges_reached(number(feature), edges[1:-1])


def bin_counts(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, bin) counts per side with the current side's extremes; ``df`` is tagged."""
    is_ref = F.col(IS_REFERENCE)
    long = _long(
        df, list(edges), [IS_REFERENCE], bin=lambda f: value_bin(f, edges[f]), value=number
    ).where(F.col("bin").isNotNull())
    return long.groupBy("feature", "bin").agg(
        F.count_if(is_ref).alias("n_ref"),
        F.count_if(~is_ref).alias("n_cur"),
        F.min(F.when(~is_ref, F.col("value"))).alias("cur_min"),
        F.max(F.when(~is_ref, F.col("value"))).alias("cur_max"),
    )


def _bin_grid(spark: SparkSession, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Every bin of every feature, also the ones no value falls into: features x bins rows."""
    rows = [
        (f, b, max(len(e) - 1, 1), e[0] if len(e) == 1 else None)
        for f, e in edges.items()
        for b in range(max(len(e) - 1, 1))
    ]
    return spark.createDataFrame(rows, "feature string, bin int, n_bins int, ref_constant double")


def _psi_term(n_ref: Column, n_cur: Column, all_ref: Column, all_cur: Column, k: Column) -> Column:
    ref = (n_ref + EPSILON) / (all_ref + EPSILON * k)
    cur = (n_cur + EPSILON) / (all_cur + EPSILON * k)
    return (cur - ref) * F.ln(cur / ref)


def psi_from_bins(counts: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """PSI per feature from its bin counts.

    A constant reference has no bins: against a constant current batch the index is 0 or 1 by equality,
    against a varying one it is 0. An empty side gives 0.
    """
    grid = _bin_grid(counts.sparkSession, edges)
    per_feature = Window.partitionBy("feature")  # at most one row per bin
    filled = (
        grid.join(counts, ["feature", "bin"], "left")
        .fillna(0, ["n_ref", "n_cur"])
        .withColumns(
            {
                "all_ref": F.sum("n_ref").over(per_feature),
                "all_cur": F.sum("n_cur").over(per_feature),
            }
        )
    )
    term = _psi_term(
        F.col("n_ref"), F.col("n_cur"), F.col("all_ref"), F.col("all_cur"), F.col("n_bins")
    )
    summed = filled.groupBy("feature").agg(
        F.sum(term).alias("raw"),
        F.max("all_ref").alias("all_ref"),
        F.max("all_cur").alias("all_cur"),
        F.max("ref_constant").alias("ref_constant"),
        F.min("cur_min").alias("cur_min"),
        F.max("cur_max").alias("cur_max"),
    )
    both_constant = F.col("ref_constant").isNotNull() & (F.col("cur_min") == F.col("cur_max"))
    psi = (
        F.when((F.col("all_ref") == 0) | (F.col("all_cur") == 0), F.lit(0.0))
        .when(both_constant, (F.col("ref_constant") != F.col("cur_min")).cast("double"))
        .otherwise(F.greatest(F.col("raw"), F.lit(0.0)))
    )
    return summed.select("feature", psi.alias("psi"))


def psi_numeric(
    reference: DataFrame, current: DataFrame, features: Sequence[str], n_bins: int = 10
) -> DataFrame:
    edges = bin_edges(reference, features, n_bins)
    return psi_from_bins(bin_counts(tagged_numbers(reference, current, features), edges), edges)


def category_counts(
    reference: DataFrame, current: DataFrame, features: Sequence[str]
) -> DataFrame:
    """Union of both batches' categories with a count per side: one shuffle, no join."""
    is_ref = F.col(IS_REFERENCE)
    return (
        _long(
            tagged_categories(reference, current, features),
            features, [IS_REFERENCE], category=F.col,
        )
        .where(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(F.count_if(is_ref).alias("n_ref"), F.count_if(~is_ref).alias("n_cur"))
    )


def psi_categorical(
    reference: DataFrame, current: DataFrame, features: Sequence[str]
) -> DataFrame:
    return psi_from_categories(category_counts(reference, current, features), features)


def psi_from_categories(counts: DataFrame, features: Sequence[str]) -> DataFrame:
    """PSI per feature from (feature, category, n_ref, n_cur); a feature without counts on a side gives 0."""
    totals = counts.groupBy("feature").agg(
        F.sum("n_ref").alias("all_ref"),
        F.sum("n_cur").alias("all_cur"),
        F.count("*").alias("k"),
    )
    term = _psi_term(
        F.col("n_ref"), F.col("n_cur"), F.col("all_ref"), F.col("all_cur"), F.col("k")
    )
    summed = (
        counts.join(F.broadcast(totals), "feature")  # one row per feature
        .groupBy("feature")
        .agg(F.sum(term).alias("raw"), F.min("all_ref").alias("r"), F.min("all_cur").alias("c"))
    )
    wanted = counts.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    psi = F.when((F.col("r") > 0) & (F.col("c") > 0), F.greatest(F.col("raw"), F.lit(0.0)))
    return wanted.join(summed, "feature", "left").select(
        "feature", F.coalesce(psi, F.lit(0.0)).alias("psi")
    )


# --- empirical distributions ------------------------------------------------------------------------


def ecdf(
    reference: DataFrame, current: DataFrame, features: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """Both empirical distribution functions at every distinct value of either batch."""
    tagged = tagged_numbers(reference, current, features)
    splits = range_splits(tagged, features, buckets)
    is_ref = F.col(IS_REFERENCE)
    tallies = (
        _long(
            with_range_bucket(tagged, features, splits, "__bucket"),
            features,
            [IS_REFERENCE],
            **{BUCKET: lambda f: F.col(f"{f}__bucket").cast("int"), "value": F.col},
        )
        .where(F.col("value").isNotNull())
        .groupBy("feature", BUCKET, "value")
        .agg(F.count_if(is_ref).alias("n_ref"), F.count_if(~is_ref).alias("n_cur"))
    )
    running = running_totals(tallies, ["feature"], "value", ["n_ref", "n_cur"])
    return running.select(
        "feature",
        "value",
        "next_value",
        F.try_divide(F.col("n_ref_before") + F.col("n_ref"), F.col("n_ref_total")).alias("f_ref"),
        F.try_divide(F.col("n_cur_before") + F.col("n_cur"), F.col("n_cur_total")).alias("f_cur"),
        "n_ref_total",
        "n_cur_total",
    )


#: Samples up to this size get the exact distribution of the KS distance (fixed value).
EXACT_ROWS = 10_000


def exact_pvalue(distance: float, n_ref: int, n_cur: int) -> float:
    """Chance of a KS distance at least that large between samples of one continuous distribution.

    All orders of the pooled values are lattice paths from (0, 0) to (n_ref, n_cur); the distance stays below a limit
    on paths inside a band around the diagonal. The share of the paths that stay inside is carried along the
    diagonals, all places of a diagonal at once; the band bounds the work by the distance times the sizes.
    """
    limit = round(distance * n_ref * n_cur)
    if limit <= 0:
        return 1.0
    total = n_ref + n_cur
    half = limit // total + 2
    place = np.arange(2 * half + 1)
    inside = np.zeros(2 * half + 1)
    inside[half] = 1.0
    centre = 0
    for step in range(1, total + 1):
        moved = step * n_ref // total
        padded = np.concatenate([[0.0], inside, [0.0]])
        shift = moved - centre
        i = moved - half + place
        j = step - i
        inside = (padded[shift : shift + len(place)] * i + padded[shift + 1 : shift + 1 + len(place)] * j) / step
        inside[(i < 0) | (i > n_ref) | (j < 0) | (j > n_cur) | (np.abs(i * n_cur - j * n_ref) >= limit)] = 0.0
        centre = moved
    return min(max(1.0 - float(inside[half]), 0.0), 1.0)


@F.pandas_udf(T.DoubleType())
def _exact_pvalues(distance: pd.Series, n_ref: pd.Series, n_cur: pd.Series) -> pd.Series:
    """One row per feature; null beyond the size that gets the exact distribution."""
    return pd.Series(
        [
            exact_pvalue(d, int(n), int(m)) if n <= EXACT_ROWS and m <= EXACT_ROWS and d == d else None
            for d, n, m in zip(distance, n_ref.fillna(EXACT_ROWS + 1), n_cur.fillna(EXACT_ROWS + 1), strict=True)
        ],
        dtype="float64",
    )


def asymptotic_pvalue(distance: Column, n_ref: Column, n_cur: Column, terms: int = 100) -> Column:
    """Two-sided asymptotic p-value with the small-sample correction of the effective size."""
    size = n_ref.cast("double") * n_cur / (n_ref + n_cur)
    root = F.sqrt(size)
    x = (root + 0.12 + F.lit(0.11) / root) * distance
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, j: total
        + F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(-2.0 * j * j * x * x),
    )
    # below 0.2 the series has not converged and the true value is 1 to nine digits
    p = F.when(x < 0.2, F.lit(1.0)).otherwise(2.0 * series)
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def ks_pvalue(distance: Column, n_ref: Column, n_cur: Column) -> Column:
    """Two-sided p-value: exact for samples of at most EXACT_ROWS, else asymptotic. For rows per feature."""
    small = F.greatest(n_ref, n_cur) <= EXACT_ROWS
    exact = _exact_pvalues(distance.cast("double"), n_ref.cast("bigint"), n_cur.cast("bigint"))
    return F.when(small, exact).otherwise(asymptotic_pvalue(distance, n_ref, n_cur))


def distribution_distances(
    reference: DataFrame, current: DataFrame, features: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """KS statistic, its p-value and the Wasserstein distance per feature.

    Fewer than two values on a side give (0, 1) and a null Wasserstein distance.
    """
    gap = F.abs(F.col("f_ref") - F.col("f_cur"))
    step = F.col("next_value") - F.col("value")
    found = ecdf(reference, current, features, buckets).groupBy("feature").agg(
        F.max(gap).alias("d"),
        F.coalesce(F.sum(gap * step), F.lit(0.0)).alias("w"),
        F.max("n_ref_total").alias("n_ref"),
        F.max("n_cur_total").alias("n_cur"),
    )
    wanted = reference.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    enough = (F.col("n_ref") >= 2) & (F.col("n_cur") >= 2)
    return wanted.join(found, "feature", "left").select(
        "feature",
        F.when(enough, F.col("d")).otherwise(F.lit(0.0)).alias("ks_statistic"),
        F.when(enough, ks_pvalue(F.col("d"), F.col("n_ref"), F.col("n_cur")))
        .otherwise(F.lit(1.0))
        .alias("ks_pvalue"),
        F.when(enough, F.col("w")).alias("wasserstein"),
    )


# --- verdicts and report ----------------------------------------------------------------------------


def feature_verdict(
    metrics: DataFrame,
    psi_threshold: float = DRIFT_PSI,
    warning_threshold: float = WARNING_PSI,
    ks_alpha: float = KS_ALPHA,
) -> DataFrame:
    """Level from PSI alone; the flag also accepts a significant KS distance."""
    psi = F.col("psi")
    by_ks = (F.col("ks_pvalue") < ks_alpha) & (F.col("ks_statistic") > KS_DISTANCE)
    return metrics.withColumns(
        {
            "drift_level": F.when(psi >= psi_threshold, "DRIFT_DETECTED")
            .when(psi >= warning_threshold, "WARNING")
            .otherwise("STABLE"),
            "has_drift": (psi >= psi_threshold) | F.coalesce(by_ks, F.lit(False)),
        }
    )


def dataset_verdict(verdicts: DataFrame) -> DataFrame:
    """Drifted when two features or a fifth of all features drifted."""
    n, total = F.col("drifted_features_count"), F.col("total_features_evaluated")
    return verdicts.agg(
        F.count_if("has_drift").alias("drifted_features_count"),
        F.count("*").alias("total_features_evaluated"),
        F.array_sort(F.collect_list(F.when(F.col("has_drift"), F.col("feature")))).alias(
            "drifted_features"
        ),  # at most one entry per feature
    ).withColumn(
        "is_dataset_drifted", (n >= 2) | F.coalesce(F.try_divide(n, total) >= 0.20, F.lit(False))
    )


def _unknown(spark: SparkSession, features: Sequence[str], kind: str) -> DataFrame:
    """Features the reference does not hold: no evidence of drift."""
    ks = (0.0, 1.0) if kind == "numeric" else (None, None)
    return spark.createDataFrame(
        [(f, kind, 0.0, *ks) for f in features],
        "feature string, feature_type string, psi double, ks_statistic double, ks_pvalue double",
    )


def feature_report(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    **thresholds,
) -> DataFrame:
    """One row per feature of the current batch; numbers rounded to four places after the verdict."""
    spark = reference.sparkSession
    parts = []
    for kind, names in (("numeric", numeric), ("categorical", categorical)):
        present = [f for f in names if f in current.columns]
        shared = [f for f in present if f in reference.columns]
        absent = [f for f in present if f not in reference.columns]
        if shared and kind == "numeric":
            parts.append(
                psi_numeric(reference, current, shared)
                .join(distribution_distances(reference, current, shared), "feature")
                .select("feature", F.lit(kind).alias("feature_type"), "psi", "ks_statistic",
                        "ks_pvalue")
            )
        elif shared:
            parts.append(
                psi_categorical(reference, current, shared).select(
                    "feature", F.lit(kind).alias("feature_type"), "psi",
                    F.lit(None).cast("double").alias("ks_statistic"),
                    F.lit(None).cast("double").alias("ks_pvalue"),
                )
            )
        if absent:
            parts.append(_unknown(spark, absent, kind))
    metrics = parts[0] if parts else _unknown(spark, [], "numeric")
    for part in parts[1:]:
        metrics = metrics.unionByName(part)
    verdicts = feature_verdict(metrics, **thresholds)
    return verdicts.withColumns(
        {c: rounded(F.col(c), 4) for c in ("psi", "ks_statistic", "ks_pvalue")}
    )


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    **thresholds,
) -> DataFrame:
    """One row: sample sizes, dataset verdict and the per-feature metrics as an array of structs."""
    rows = feature_report(reference, current, numeric, categorical, **thresholds)
    names = ["feature", "feature_type", "psi", "ks_statistic", "ks_pvalue", "drift_level",
             "has_drift"]
    metrics = rows.agg(  # at most one entry per feature
        F.array_sort(F.collect_list(F.struct(*names))).alias("feature_metrics"),
    )
    return (
        metrics.select(
            F.lit(reference.count()).cast("bigint").alias("n_reference_samples"),
            F.lit(current.count()).cast("bigint").alias("n_current_samples"),
            "feature_metrics",
            F.transform(
                F.filter("feature_metrics", lambda m: m["has_drift"]), lambda m: m["feature"]
            ).alias("drifted_features"),
        )
        .select(
            F.current_timestamp().alias("created_at"),
            "n_reference_samples",
            "n_current_samples",
            F.size("drifted_features").alias("drifted_features_count"),
            F.size("feature_metrics").alias("total_features_evaluated"),
            "drifted_features",
            (
                (F.size("drifted_features") >= 2)
                | F.coalesce(
                    F.try_divide(F.size("drifted_features"), F.size("feature_metrics")) >= 0.20,
                    F.lit(False),
                )
            ).alias("is_dataset_drifted"),
            "feature_metrics",
        )
    )


# --- stored baseline --------------------------------------------------------------------------------


def baseline_bins(reference: DataFrame, features: Sequence[str], n_bins: int = 10) -> DataFrame:
    """(feature, edges, counts): what PSI needs later without the reference rows."""
    edges = bin_edges(reference, features, n_bins)
    tagged = reference.withColumn(IS_REFERENCE, F.lit(True))
    counts = bin_counts(tagged, edges).select("feature", "bin", "n_ref")
    stored = (
        _bin_grid(reference.sparkSession, edges)
        .join(counts, ["feature", "bin"], "left")
        .fillna(0, ["n_ref"])
        .groupBy("feature")
        .agg(F.array_sort(F.collect_list(F.struct("bin", "n_ref"))).alias("bins"))
    )
    known = reference.sparkSession.createDataFrame(
        list(edges.items()), "feature string, edges array<double>"
    )
    return known.join(stored, "feature").select(
        "feature", "edges", F.transform("bins", lambda b: b["n_ref"]).alias("counts")
    )


def psi_from_baseline(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """PSI of a batch against stored bins; one pass over the batch."""
    stored = [r for r in baseline.collect() if r["feature"] in current.columns]  # row per feature
    edges = {r["feature"]: list(r["edges"]) for r in stored}
    counted = bin_counts(current.withColumn(IS_REFERENCE, F.lit(False)), edges).drop("n_ref")
    reference = current.sparkSession.createDataFrame(
        [(r["feature"], b, n) for r in stored for b, n in enumerate(r["counts"])],
        "feature string, bin int, n_ref bigint",
    )
    return psi_from_bins(reference.join(counted, ["feature", "bin"], "left"), edges)


def categorical_psi_from_baseline(profile: DataFrame, current: DataFrame) -> DataFrame:
    """PSI of a batch against the stored counts of :func:`categorical_profile`; one pass over the batch."""
    named = [r["feature"] for r in profile.select("feature").distinct().collect()]  # one row per feature
    features = [f for f in named if f in current.columns]
    stored = profile.where(F.col("feature").isin(features)).select("feature", "category", F.col("n").alias("n_ref"))
    found = categorical_profile(current, features).select("feature", "category", F.col("n").alias("n_cur"))
    counts = stored.join(found, ["feature", "category"], "full").fillna(0, ["n_ref", "n_cur"])
    return psi_from_categories(counts, features)
