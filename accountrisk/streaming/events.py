"""Event-time windows over the activity stream.

Each function takes a streaming (or batch) frame with ``ts``, ``user_id``, ``event_id`` and ``value`` and
returns the transformed frame; append mode emits a window once the watermark has passed its end, which
keeps state bounded by the watermark delay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from accountrisk.functions.numeric import edges_reached
from accountrisk.operators.drift import EPSILON

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def with_event_time(events: DataFrame) -> DataFrame:
    """Watermarks need a zoned timestamp; the session zone is UTC."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def event_stream(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    return with_event_time(
        spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", pattern).parquet(folder)
    )


def append_to(df: DataFrame, path: str) -> StreamingQuery:
    """Process what is available and append finished rows to Parquet, exactly once."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{path}/data")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def tumbling_bins(
    events: DataFrame, edges: Sequence[float], width: str = "5 days", delay: str = "1 day"
) -> DataFrame:
    """Values per window and reference bin, one row per window with a count column per bin."""
    index = edges_reached(F.col("value"), edges[1:-1])
    n_bins = max(len(edges) - 1, 1)
    return (
        events.where(F.col("value").isNotNull())
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", width))
        .agg(*[F.count_if(index == b).alias(f"bin_{b}") for b in range(n_bins)])
    )


def window_psi(n_bins: int, reference_counts: Sequence[int]) -> Column:
    """PSI of a window's bin columns against fixed reference counts."""
    all_ref = float(sum(reference_counts))
    all_cur = sum((F.col(f"bin_{b}") for b in range(n_bins)), F.lit(0))
    total = F.lit(0.0)
    for b in range(n_bins):
        ref = F.lit((reference_counts[b] + EPSILON) / (all_ref + EPSILON * n_bins))
        cur = (F.col(f"bin_{b}") + EPSILON) / (all_cur + EPSILON * n_bins)
        total = total + (cur - ref) * F.ln(cur / ref)
    return F.greatest(total, F.lit(0.0))


def tumbling_drift(
    events: DataFrame, edges: Sequence[float], reference_counts: Sequence[int], **options
) -> DataFrame:
    """PSI per closed window against stored reference bins."""
    bins = tumbling_bins(events, edges, **options)
    n_bins = len(reference_counts)
    return bins.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        sum((F.col(f"bin_{b}") for b in range(n_bins)), F.lit(0)).alias("n_values"),
        window_psi(n_bins, reference_counts).alias("psi"),
    )


def sliding_activity(
    events: DataFrame, width: str = "30 days", slide: str = "1 day", delay: str = "1 day"
) -> DataFrame:
    """Active users and events per sliding window.

    Events are first reduced to one row per user and slide; only those rows fan out to the windows
    that cover them. The three chained aggregates give exact distinct users.
    """
    per_step = (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", slide).alias("step"), "user_id")
        .agg(F.count("*").alias("n"))
    )
    per_user = (
        per_step.withColumn("at", F.window_time("step"))
        .groupBy(F.window("at", width, slide).alias("span"), "user_id")
        .agg(F.sum("n").alias("n"))
    )
    return (
        per_user.withColumn("at", F.window_time("span"))
        .groupBy(F.window("at", slide).alias("closing"))
        .agg(F.count("*").alias("active_users"), F.sum("n").alias("n_events"))
        .select(F.col("closing.end").alias("window_end"), "active_users", "n_events")
    )


def session_activity(events: DataFrame, gap: str = "6 hours", delay: str = "1 day") -> DataFrame:
    """Sessions per user: start, end (last event plus the gap) and number of events."""
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.session_window("ts", gap).alias("session"), "user_id")
        .agg(F.count("*").alias("n_events"))
        .select(
            "user_id",
            F.col("session.start").alias("session_start"),
            F.col("session.end").alias("session_end"),
            "n_events",
        )
    )


def daily_counts(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Events per day, each event id once; rows older than the watermark are dropped.

    The deduplication meets every row before any aggregation, so the rows it drops are the late rows themselves and
    :func:`late_rows` counts them exactly.
    """
    return (
        deduplicated(events, delay)
        .groupBy(F.window("ts", "1 day"))
        .agg(F.count("*").alias("n_events"))
        .select(F.col("window.start").alias("day"), "n_events")
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that the deduplication of a query dropped as older than the watermark, over its recent batches."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
        if operator.operatorName.startswith("dedupe")
    )


def deduplicated(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """One row per event id within the watermark."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
