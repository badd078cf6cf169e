"""Versioned model folders, a registry table and integrity checks."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

REGISTRY_SCHEMA = (
    "model_name string, version string, created_at timestamp, algorithm string,"
    " best_threshold double, calibrated boolean, input_features array<string>,"
    " target_column string, validation_metrics map<string,double>,"
    " business_parameters map<string,double>, path string, checksum string"
)


def model_checksum(spark: SparkSession, path: str) -> str:
    """SHA-256 over the sorted (relative path, SHA-256) list of a model folder's files."""
    folder = path.rstrip("/").rsplit("/", 1)[-1]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    entry = F.concat_ws(
        ":", F.substring_index("path", f"{folder}/", -1), F.sha2("content", 256)
    )
    # a model folder holds a few hundred files
    listed = files.agg(F.array_sort(F.collect_list(entry)).alias("files"))
    return listed.select(F.sha2(F.array_join("files", ","), 256)).first()[0]


def save_model(
    model,
    spark: SparkSession,
    root: str,
    model_name: str,
    version: str,
    algorithm: str,
    input_features: list[str],
    best_threshold: float = 0.5,
    calibrated: bool = True,
    target_column: str = "churn",
    validation_metrics: dict[str, float] | None = None,
    business_parameters: dict[str, float] | None = None,
) -> Row:
    """Write the model to a folder of its own and append its row to the registry."""
    now = datetime.now(timezone.utc)
    path = f"{root.rstrip('/')}/{model_name}_{version}_{now:%Y%m%d_%H%M%S_%f}"
    model.write().save(path)
    row = Row(
        model_name=model_name,
        version=version,
        created_at=now,
        algorithm=algorithm,
        best_threshold=float(best_threshold),
        calibrated=calibrated,
        input_features=list(input_features),
        target_column=target_column,
        validation_metrics={k: float(v) for k, v in (validation_metrics or {}).items()},
        business_parameters={k: float(v) for k, v in (business_parameters or {}).items()},
        path=path,
        checksum=model_checksum(spark, path),
    )
    spark.createDataFrame([row], REGISTRY_SCHEMA).write.mode("append").parquet(f"{root}/registry")
    return row


def registry(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).parquet(f"{root}/registry")


def latest(spark: SparkSession, root: str, model_name: str) -> Row:
    """Newest registry row of a model."""
    rows = registry(spark, root).where(F.col("model_name") == model_name)
    best = rows.agg(F.max_by(F.struct("*"), F.col("created_at")).alias("row")).first()["row"]
    if best is None:
        raise FileNotFoundError(f"no model named {model_name} in {root}")
    return best


def load_model(spark: SparkSession, path: str, checksum: str | None = None):
    """Load a model folder; a missing folder or a different checksum is an error."""
    try:
        found = model_checksum(spark, path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no model at {path}") from error
    if checksum and found != checksum:
        raise ValueError(f"model at {path} has checksum {found}, registered is {checksum}")
    return DefaultParamsReader.loadParamsInstance(path, spark)
