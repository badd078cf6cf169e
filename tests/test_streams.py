from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from accountrisk.sources.mart import MART_CATEGORIES, table
from accountrisk.streaming import accounts as A
from accountrisk.streaming import events as E
from feeds import raw_feed

SMALL = "/root/testdata/sf0.001"


def run(stream, path):
    E.append_to(stream, str(path)).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/data")


def test_gate_splits_every_account_once_and_replays_cleanly(spark, mart, tmp_path):
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    feed = raw_feed(mart)
    feed.where("customer_id % 2 = 0").write.parquet(inbox)
    stream = A.account_stream(spark, inbox, feed.schema)
    A.gate_and_score(stream, out, MART_CATEGORIES).awaitTermination()
    feed.where("customer_id % 2 = 1").write.mode("append").parquet(inbox)
    for _ in range(2):  # the second start finds nothing new
        A.gate_and_score(
            A.account_stream(spark, inbox, feed.schema), out, MART_CATEGORIES
        ).awaitTermination()
    schema = A.routed(stream, MART_CATEGORIES).schema
    scored, rejected = (A.sink_rows(spark, out, sink, schema) for sink in ("scored", "quarantine"))
    assert rejected.where("risk_level IS NOT NULL OR churn_probability IS NOT NULL").isEmpty() and rejected.count() > 0
    ids = scored.select("customer_id").union(rejected.select("customer_id"))
    assert ids.count() == ids.distinct().count() == mart.count()
    assert scored.where(F.col("risk_level").isNull()).isEmpty()
    assert rejected.where(F.size("violations") == 0).isEmpty()


def stamp(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def write_events(spark, path, rows):
    data = [(i, ts, user, "click", float(value)) for i, ts, user, value in rows]
    spark.createDataFrame(data, E.EVENT_SCHEMA).write.mode("append").parquet(str(path))


def test_sessions_split_at_the_gap(spark, tmp_path):
    rows = [(1, stamp(1, 0), 7, 1), (2, stamp(1, 5), 7, 1), (3, stamp(1, 12), 7, 1),
            (4, stamp(1, 1), 8, 1), (5, stamp(20), 9, 1)]
    write_events(spark, tmp_path / "in", rows)
    found = run(E.session_activity(E.event_stream(spark, str(tmp_path / "in"))), tmp_path / "out")
    sessions = sorted((r["user_id"], r["session_start"], r["n_events"]) for r in found.collect())
    assert sessions == [(7, stamp(1, 0), 2), (7, stamp(1, 12), 1), (8, stamp(1, 1), 1)]


def test_late_rows_are_dropped(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    write_events(spark, source, [(1, stamp(10), 1, 1), (2, stamp(15), 1, 1)])
    run(E.daily_counts(E.event_stream(spark, str(source))), out)
    write_events(spark, source, [(3, stamp(10, 5), 1, 1), (4, stamp(16), 1, 1),
                                 (5, stamp(20), 1, 1)])
    found = run(E.daily_counts(E.event_stream(spark, str(source))), out)
    assert sorted((r["day"].day, r["n_events"]) for r in found.collect()) == [
        (10, 1), (15, 1), (16, 1)
    ]


def test_late_rows_are_counted(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write_events(spark, source, [(1, stamp(10), 1, 1), (2, stamp(15), 1, 1)])
    counts = []
    for more in ([], [(k, stamp(10, k), 1, 1) for k in range(3, 9)], [(20, stamp(16), 1, 1), (21, stamp(12), 1, 1)]):
        if more:
            write_events(spark, source, more)
        query = E.append_to(E.daily_counts(E.event_stream(spark, str(source))), out)
        query.awaitTermination()
        counts.append(E.late_rows(query))
    assert counts == [0, 6, 1]


def test_duplicates_across_batches_come_out_once(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    write_events(spark, source, [(1, stamp(1), 1, 1), (2, stamp(1, 2), 1, 1)])
    run(E.deduplicated(E.event_stream(spark, str(source))), out)
    write_events(spark, source, [(2, stamp(1, 2), 1, 1), (3, stamp(1, 3), 1, 1)])
    found = run(E.deduplicated(E.event_stream(spark, str(source))), out)
    assert sorted(r["event_id"] for r in found.collect()) == [1, 2, 3]


def test_window_psi_of_the_reference_itself_is_zero(spark):
    df = spark.createDataFrame([(3, 5, 2)], "bin_0 int, bin_1 int, bin_2 int")
    assert df.select(E.window_psi(3, [3, 5, 2])).first()[0] == 0.0
    assert df.select(E.window_psi(3, [2, 5, 3])).first()[0] > 0.0


def test_batch_and_stream_give_the_same_bins(spark, tmp_path):
    edges = [-2.0, 0.0, 1.0, 2.0]
    batch = E.tumbling_bins(E.with_event_time(table(spark, SMALL, "events")), edges)
    stream = run(
        E.tumbling_bins(E.event_stream(spark, SMALL, "events.parquet"), edges), tmp_path / "bins"
    )
    ends = [r["window"]["end"] for r in stream.collect()]
    expected = batch.where(F.col("window.end") <= F.lit(max(ends)))
    assert sorted(map(str, stream.collect())) == sorted(map(str, expected.collect()))


def test_work_folder(spark):
    from accountrisk import session

    class Fake:
        class conf:  # noqa: N801 - stands for the session's settings
            @staticmethod
            def get(key, default=None):
                return {"spark.sql.warehouse.dir": "/shared/warehouse/"}.get(key, default)

    assert session.work_folder(Fake()) == "/shared/warehouse/work"
    assert session.work_folder(spark) == spark.conf.get("spark.checkpoint.dir")
