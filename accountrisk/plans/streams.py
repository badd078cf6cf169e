"""Streaming queries: each runs its stream over the available files and reads the sink back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountrisk.operators import drift as D
from accountrisk.plans.catalog import query
from accountrisk.plans.intake import CHECKED
from accountrisk.plans.sql import MART_CTE, SCORED
from accountrisk.session import new_path, written
from accountrisk.sources.mart import SERVED_CATEGORIES, account_mart, table
from accountrisk.streaming import accounts as A
from accountrisk.streaming import events as E

CLOSED = "(SELECT max(ts) - INTERVAL 1 DAY FROM events)"


def finished(stream: DataFrame, path: str) -> DataFrame:
    """Run to the end of the available input and read the sink."""
    E.append_to(stream, path).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/data")


def as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names})


@query(
    "q_stream_gate_score",
    MART_CTE
    + CHECKED
    + SCORED.replace("FROM mart", "FROM checked WHERE len(violations) = 0")
    + " SELECT customer_id::VARCHAR AS customer_id, 'scored' AS sink, churn_probability, risk_level"
    + " FROM scored UNION ALL SELECT customer_id::VARCHAR, 'quarantine', NULL, NULL FROM checked"
    + " WHERE len(violations) > 0",
)
def stream_gate_score(spark, folder):
    arrived = written(account_mart(spark, folder), "arrived")
    out = new_path(spark, "account-stream")
    (path,) = {f.rsplit("/", 1)[0] for f in arrived.inputFiles()}
    stream = A.account_stream(spark, path, arrived.schema)
    A.gate_and_score(stream, out, SERVED_CATEGORIES).awaitTermination()
    schema = A.routed(stream, SERVED_CATEGORIES).schema
    sinks = [A.sink_rows(spark, out, name, schema) for name in ("scored", "quarantine")]
    return sinks[0].union(sinks[1]).select("customer_id", "sink", "churn_probability", "risk_level")


@query(
    "q_stream_tumbling_drift",
    f"""WITH ref AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-11' AND value IS NOT NULL),
e AS (SELECT list_sort(list_distinct(quantile_cont(value,
  [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM ref),
rb AS (SELECT len([x FOR x IN e[2:len(e) - 1] IF x <= value]) AS bin, count(*)::DOUBLE AS n
  FROM ref, e GROUP BY 1),
w AS (SELECT time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '1970-01-01') AS ws,
  len([x FOR x IN e[2:len(e) - 1] IF x <= value]) AS bin FROM events, e WHERE value IS NOT NULL),
c AS (SELECT ws, bin, count(*)::DOUBLE AS n FROM w GROUP BY ws, bin),
g AS (SELECT ws, unnest(range(len(e) - 1)) AS bin, len(e) - 1 AS k FROM (SELECT DISTINCT ws FROM w), e),
s AS (SELECT g.ws, coalesce(c.n, 0) AS n,
  (coalesce(rb.n, 0) + 1e-4) / ((SELECT count(*) FROM ref) + 1e-4 * k) AS rp,
  (coalesce(c.n, 0) + 1e-4) / (sum(coalesce(c.n, 0)) OVER (PARTITION BY g.ws) + 1e-4 * k) AS cp
  FROM g LEFT JOIN c ON c.ws = g.ws AND c.bin = g.bin LEFT JOIN rb ON rb.bin = g.bin)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, sum(n)::BIGINT AS n_values,
  round_even(greatest(sum((cp - rp) * ln(cp / rp)), 0e0), 6) AS psi
FROM s WHERE ws + INTERVAL 5 DAY <= {CLOSED} GROUP BY ws""",
)
def stream_tumbling_drift(spark, folder):
    """Five-day windows of event values against the bins of the first ten days."""
    baseline = table(spark, folder, "events").where(
        F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz")
    )
    stored = D.baseline_bins(baseline, ["value"]).first()
    stream = E.tumbling_drift(
        E.event_stream(spark, folder, "events.parquet"), stored["edges"], stored["counts"]
    )
    out = finished(stream, new_path(spark, "tumbling"))
    return as_text(out, "window_start").select(
        "window_start", "n_values", F.bround("psi", 6).alias("psi")
    )


@query(
    "q_stream_sliding_activity",
    f"""WITH d AS (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS day, user_id FROM events),
ends AS (SELECT unnest(range(min(day) + INTERVAL 1 DAY, max(day) + INTERVAL 31 DAY, INTERVAL 1 DAY))
  AS window_end FROM d)
SELECT strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end,
  count(DISTINCT user_id)::BIGINT AS active_users, count(*)::BIGINT AS n_events
FROM ends JOIN events ON ts < window_end AND ts >= window_end - INTERVAL 30 DAY
WHERE window_end <= {CLOSED} GROUP BY window_end""",
)
def stream_sliding_activity(spark, folder):
    stream = E.sliding_activity(E.event_stream(spark, folder, "events.parquet"))
    return as_text(finished(stream, new_path(spark, "sliding")), "window_end")


@query(
    "q_stream_session_activity",
    f"""WITH m AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1
  END AS starts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(starts) OVER (PARTITION BY user_id ORDER BY ts) AS nr FROM m)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start,
  strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS session_end,
  count(*)::BIGINT AS n_events
FROM s GROUP BY user_id, nr HAVING max(ts) + INTERVAL 6 HOUR <= {CLOSED}""",
)
def stream_session_activity(spark, folder):
    stream = E.session_activity(E.event_stream(spark, folder, "events.parquet"))
    out = finished(stream, new_path(spark, "sessions"))
    return as_text(out, "session_start", "session_end")


@query(
    "q_stream_late_drop",
    f"""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS day,
  count(*)::BIGINT AS n_events,
  (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-16' AND ts < {CLOSED})::BIGINT AS n_dropped
FROM events WHERE ts >= TIMESTAMP '2024-01-16'
GROUP BY date_trunc('day', ts)
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= {CLOSED}""",
)
def stream_late_drop(spark, folder):
    """The second half of the month arrives first; the first half then comes too late and is counted as dropped."""
    events = table(spark, folder, "events").select(*E.EVENT_SCHEMA.names)
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    inbox, out = new_path(spark, "inbox"), new_path(spark, "late")
    dropped = 0
    for part in (F.col("ts") >= middle, F.col("ts") < middle):
        events.where(part).write.mode("append").parquet(inbox)
        stream = E.daily_counts(E.event_stream(spark, inbox))
        query_ = E.append_to(stream, out)
        query_.awaitTermination()
        dropped += E.late_rows(query_)
    result = spark.read.schema(stream.schema).parquet(f"{out}/data")
    return as_text(result, "day").withColumn("n_dropped", F.lit(dropped).cast("bigint"))


@query(
    "q_stream_dedup",
    "SELECT event_id, user_id, event_type FROM events",
)
def stream_dedup(spark, folder):
    """Every event delivered twice comes out once."""
    events = table(spark, folder, "events").select(*E.EVENT_SCHEMA.names)
    inbox = new_path(spark, "inbox")
    events.write.mode("append").parquet(inbox)
    events.write.mode("append").parquet(inbox)
    unique = finished(E.deduplicated(E.event_stream(spark, inbox)), new_path(spark, "unique"))
    return unique.select("event_id", "user_id", "event_type")
