"""Arriving accounts: contract gate, scoring and quarantine as a stateless stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from accountrisk.functions.contract import with_default_id, with_violations
from accountrisk.functions.scoring import rule_probability, score_accounts
from accountrisk.schema import DEFAULT_THRESHOLD


def account_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def score_by_rules(accounts: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    return score_accounts(accounts, rule_probability(), threshold)


def routed(
    accounts: DataFrame,
    categories: Mapping[str, Sequence[str]] | None = None,
    score: Callable[[DataFrame], DataFrame] = score_by_rules,
) -> DataFrame:
    """Every account once with its ``violations`` and ``sink``: ``scored``, or ``quarantine`` with empty scores.

    One pass serves both sinks, so ``score`` also sees accounts that break the contract; what it says of them is
    dropped.
    """
    checked = with_violations(with_default_id(accounts), categories)
    valid = F.size("violations") == 0
    scored = score(checked)
    added = [c for c in scored.columns if c not in checked.columns]
    kept = scored.withColumns({c: F.when(valid, F.col(c)) for c in added})
    return kept.withColumn("sink", F.when(valid, "scored").otherwise("quarantine"))


def sink_rows(spark: SparkSession, out: str, sink: str, schema: T.StructType) -> DataFrame:
    """What the batches so far put into a sink; only its folders are read."""
    return spark.read.schema(schema).parquet(f"{out}/accounts").where(F.col("sink") == sink)


def gate_and_score(
    stream: DataFrame,
    out: str,
    categories: Mapping[str, Sequence[str]] | None = None,
    score: Callable[[DataFrame], DataFrame] = score_by_rules,
) -> StreamingQuery:
    """Accounts go to ``out/accounts``, one folder per micro-batch and sink: valid ones scored, the rest with their
    violations.

    A micro-batch is read, checked and written once, and overwrites the folder of its own number: a replayed batch
    replaces both its sinks together instead of adding to them.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = routed(batch, categories, score)
        rows.write.mode("overwrite").partitionBy("sink").parquet(f"{out}/accounts/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
