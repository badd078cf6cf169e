"""Session settings, the shared work folder and written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # sessions of one hot user are merged inside each map task before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(
    app_name: str = "accountrisk",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get a session with the settings the library expects; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """Shared folder for written intermediates: ``spark.checkpoint.dir``, else a folder in the warehouse.

    Both are shared by the driver and all executors; a machine-local folder would lose data with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the work folder."""
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the work folder and continue from that table.

    Cuts the lineage for iterative jobs: a lost executor re-reads files instead of recomputing the
    whole plan, and later passes read only the columns they use.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
