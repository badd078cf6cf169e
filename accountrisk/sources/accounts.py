"""Readers and writers for account batches, reports and baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountrisk.schema import ACCOUNT_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers are null from here on."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def read_accounts_csv(
    spark: SparkSession, path: str, schema: T.StructType = ACCOUNT_SCHEMA
) -> DataFrame:
    """CSV with header; rows that do not parse keep their text in ``_corrupt_record``."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    df = (
        spark.read.schema(with_corrupt)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("nanValue", "NaN")
        .csv(path)
    )
    return nan_to_null(df)


def read_accounts_parquet(
    spark: SparkSession, path: str, schema: T.StructType = ACCOUNT_SCHEMA
) -> DataFrame:
    """Parquet by a declared schema: columns the files lack are null, others are not read."""
    return nan_to_null(spark.read.schema(schema).parquet(path))


def read_accounts(
    spark: SparkSession, path: str, schema: T.StructType = ACCOUNT_SCHEMA
) -> DataFrame:
    """Pick the reader by suffix: ``.parquet`` is Parquet, everything else CSV."""
    if path.rstrip("/").endswith(".parquet"):
        return read_accounts_parquet(spark, path, schema)
    return read_accounts_csv(spark, path, schema)


def write_accounts(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write a scored or raw batch; the suffix picks the format as in ``read_accounts``."""
    if path.rstrip("/").endswith(".parquet"):
        df.write.mode(mode).parquet(path)
    else:
        df.write.mode(mode).option("header", True).csv(path)
    return path


def append_report(report: DataFrame, path: str) -> str:
    """Append a drift report as JSON, partitioned by run date."""
    report.withColumn("run_date", F.to_date("created_at")).write.mode("append").partitionBy(
        "run_date"
    ).json(path)
    return path


def save_baseline(numeric: DataFrame | None, categorical: DataFrame | None, path: str) -> str:
    """Write the two profile tables below ``path``; an absent or empty profile is an error."""
    tables = {"numeric": numeric, "categorical": categorical}
    tables = {k: v for k, v in tables.items() if v is not None and not v.isEmpty()}
    if not tables:
        raise ValueError("no baseline profile to save")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    return path


def load_baseline(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}")
