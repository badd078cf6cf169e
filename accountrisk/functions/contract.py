"""Data contract: per-row violations, quarantine and violation counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountrisk.schema import (
    CONTRACT_CATEGORIES,
    CONTRACT_NULLABLE,
    CONTRACT_RANGES,
    DEFAULT_CUSTOMER_ID,
)


def contract_violations(
    columns: Sequence[str], categories: Mapping[str, Sequence[str]] | None = None
) -> Column:
    """Array of ``field:reason`` codes for one row; empty when the row keeps the contract.

    ``columns`` are the columns present; an absent required field counts as missing in every row.
    ``categories`` replaces the allowed sets of the fields it names.
    """
    allowed = {**CONTRACT_CATEGORIES, **(categories or {})}
    checks: list[str] = []

    def check(condition: str, code: str) -> None:
        checks.append(f"CASE WHEN {condition} THEN '{code}' END")

    def required(name: str) -> None:
        check(f"{name} IS NULL" if name in columns else "TRUE", f"{name}:missing")

    for name, values in allowed.items():
        required(name)
        if name in columns:
            listed = ", ".join(_text(v) for v in values)
            check(f"{name} NOT IN ({listed})", f"{name}:enum")
    required("auto_renew_enabled")
    for name, (lower, upper) in CONTRACT_RANGES.items():
        if name not in CONTRACT_NULLABLE:
            required(name)
        if name in columns:
            above = "" if upper is None else f" OR {name} > {upper}"
            # NaN sorts above every number in Spark, so unbounded fields need their own test
            check(f"{name} < {lower}{above} OR isnan(double({name}))", f"{name}:range")
    return F.expr(f"array_compact(array({', '.join(checks)}))")


def _text(value: str) -> str:
    """String literal of a SQL expression."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def with_violations(
    df: DataFrame, categories: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    return df.withColumn("violations", contract_violations(df.columns, categories))


def split_by_contract(
    df: DataFrame, categories: Mapping[str, Sequence[str]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their violation codes)."""
    checked = with_violations(df, categories)
    valid = checked.where(F.size("violations") == 0).drop("violations")
    return valid, checked.where(F.size("violations") > 0)


def violation_summary(checked: DataFrame) -> DataFrame:
    return (
        checked.select(F.explode("violations").alias("code"))
        .groupBy("code")
        .agg(F.count("*").alias("n_rows"))
    )


def with_default_id(df: DataFrame, default: str = DEFAULT_CUSTOMER_ID) -> DataFrame:
    if "customer_id" not in df.columns:
        return df.withColumn("customer_id", F.lit(default))
    return df.withColumn(
        "customer_id", F.coalesce(F.col("customer_id").cast("string"), F.lit(default))
    )


def require_rows(df: DataFrame) -> DataFrame:
    """Reject an empty batch."""
    if df.isEmpty():
        raise ValueError("the batch holds no accounts")
    return df
