"""Exactly-once ingest by event id, late events, corrected sessions, and appends that can be repeated."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oreline.scratch import fresh_path
from oreline.sources import publish
from oreline.sources.files import data_files
from oreline.sources.publish import append_once
from oreline.streaming import dedup, session_updates
from oreline.streaming.events import read_event_files, stream_to_dates
from tests.ddl import schema as ddl

EVENT = ddl("event_id string, kind string, event_timestamp timestamp")
START = dt.datetime(2024, 1, 1)


def events(spark, *rows):
    return spark.createDataFrame([(i, "x", START + dt.timedelta(hours=h)) for i, h in rows], EVENT)


# --- appends


def test_an_append_counts_once(spark):
    path = fresh_path(spark, "once")
    rows = spark.createDataFrame([(1, "a"), (2, None)], "n int, part string")
    assert append_once(rows, path, "part", "t1") and not append_once(rows, path, "part", "t1")
    assert append_once(rows, path, "part", "t2")
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 1, 2, 2]
    assert append_once(rows.limit(0), path, "part", "t3") and spark.read.parquet(path).count() == 4


@pytest.mark.parametrize("stop_at", ["write_text", "move", "delete_dir"])
def test_a_stopped_append_goes_on(spark, monkeypatch, stop_at):
    path = fresh_path(spark, "once")
    rows = spark.createDataFrame([(n, f"p{n}") for n in range(3)], "n int, part string")
    real, calls = getattr(publish, stop_at), []

    def stop(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("stopped")
        return real(*args)

    monkeypatch.setattr(publish, stop_at, stop)
    with pytest.raises(OSError):
        append_once(rows, path, "part", "t")
    monkeypatch.undo()
    append_once(rows, path, "part", "t")
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [0, 1, 2]
    assert len(data_files(spark, path)) == 3


def test_a_hot_date_is_split(spark):
    """A third of the events on one date: its rows are dealt to several files when they are many."""
    source, path, checkpoint = (fresh_path(spark, n) for n in ("hot", "bronze", "checkpoint"))
    days = spark.range(60_000).select(
        F.col("id").cast("string").alias("event_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("kind"),
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 30) * 86400 + 1704067200).alias("event_timestamp"),
    )
    days.write.parquet(source)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        stream_to_dates(read_event_files(spark, source, EVENT), path, checkpoint, EVENT).awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {r.event_date: r["count"] for r in spark.read.parquet(path).select("event_date", "_metadata.file_path").distinct().groupBy("event_date").count().collect()}
    assert files[dt.date(2024, 1, 1)] >= 3 and sorted(files.values())[len(files) // 2] <= 2
    assert spark.read.parquet(path).count() == 60_000


# --- events by id


def ingest(spark, paths, *batches):
    source, path, late, main_checkpoint, late_checkpoint = paths
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(source)
    stream = read_event_files(spark, source, EVENT)
    dedup.stream_dedup(stream, path, main_checkpoint, lateness="10 hours").awaitTermination()
    dedup.stream_late(stream, path, late, late_checkpoint, EVENT).awaitTermination()


def stored(spark, paths):
    return sorted((r.event_id, r.is_late) for r in dedup.all_events(spark, paths[1], paths[2], EVENT).collect())


def test_each_event_once_over_restarts(spark):
    paths = [fresh_path(spark, n) for n in ("source", "main", "late", "c1", "c2")]
    first = events(spark, ("a", 0), ("b", 1), ("b", 1), ("c", 30))
    ingest(spark, paths, first)
    assert stored(spark, paths) == [("a", False), ("b", False), ("c", False)]
    ingest(spark, paths, first, events(spark, ("d", 31), ("c", 30)))  # the same file again
    assert stored(spark, paths) == [(i, False) for i in "abcd"]
    ingest(spark, paths, events(spark, ("old", 2), ("old", 2), ("a", 0), ("e", 25)))
    assert stored(spark, paths) == [("a", False), ("b", False), ("c", False), ("d", False), ("e", False), ("old", True)]
    ingest(spark, paths, events(spark, ("old", 2)))
    assert [i for i, late in stored(spark, paths) if late] == ["old"]


# --- sessions


def test_spans():
    start, end, n = session_updates.merge_spans(np.array([50, 0, 9, 100]), np.array([60, 5, 40, 100]), np.array([1, 2, 3, 4]), 10)
    assert (start.tolist(), end.tolist(), n.tolist()) == ([0, 50, 100], [40, 60, 100], [5, 1, 4])
    empty = np.empty(0, np.int64)
    assert [len(x) for x in session_updates.merge_spans(empty, empty, empty, 10)] == [0, 0, 0]


def test_fragments_are_few():
    frame = pd.DataFrame({"user": ["hot"] * 900 + ["b"] * 2, "_at": [*range(900), 0, 10**6]})
    out = pd.concat(session_updates._fragments("user", 100)(iter([frame])))
    assert sorted(out["span_events"]) == [1, 1, 900]


def test_fragments_cost_no_step_for_each_user(monkeypatch):
    """A batch of many users is folded at once; users without a name are one user."""
    calls, real = [], session_updates.merge_spans
    monkeypatch.setattr(session_updates, "merge_spans", lambda *args: calls.append(1) or real(*args))
    frame = pd.DataFrame({"user": [*(f"u{n}" for n in range(500)), None, None, None], "_at": [*range(500), 90, 10, 100]})
    out = pd.concat(session_updates._fragments("user", 50)(iter([frame, frame.iloc[:0]])))
    assert len(calls) <= 1
    named, nobody = out[out["user"].notna()], out[out["user"].isna()]
    assert named["span_events"].tolist() == [1] * 500 and set(named["user"]) == {f"u{n}" for n in range(500)}
    assert nobody[["span_start", "span_end", "span_events"]].to_numpy().tolist() == [[10, 10, 1], [90, 100, 2]]


CLICK = "user string, at timestamp"


def clicks(spark, *rows):
    return spark.createDataFrame([(u, START + dt.timedelta(minutes=m)) for u, m in rows], CLICK)


def test_sessions_are_corrected(spark):
    source, path, checkpoint = (fresh_path(spark, n) for n in ("clicks", "sessions", "checkpoint"))
    schema = ddl(CLICK)

    def arrive(*rows):
        clicks(spark, *rows).coalesce(1).write.mode("append").parquet(source)
        changes = session_updates.stream_session_updates(read_event_files(spark, source, schema), "user", "at", dt.timedelta(minutes=30), "5 hours")
        session_updates.store_session_changes(spark, changes, path, checkpoint)
        rows = session_updates.read_session_changes(spark, path, changes.schema)
        minute = lambda t: (t - START).total_seconds() / 60
        log = sorted((r.user, minute(r.session_start), minute(r.session_end), r.events, r.change) for r in rows.collect())
        net = sorted((r.user, minute(r.session_start), minute(r.session_end), r.events) for r in session_updates.net_sessions(rows, "user").collect())
        return log, net

    log, net = arrive(("a", 0), ("a", 10), ("a", 60), ("b", 5))
    assert net == [("a", 0, 10, 2), ("a", 60, 60, 1), ("b", 5, 5, 1)] and all(r[4] == 1 for r in log)
    log, net = arrive(("a", 35), ("b", 35))  # joins both sessions of a; a pause of exactly the gap ends b's
    assert net == [("a", 0, 60, 4), ("b", 5, 5, 1), ("b", 35, 35, 1)]
    assert ("a", 0, 10, 2, -1) in log and ("a", 60, 60, 1, -1) in log and ("b", 5, 5, 1, -1) not in log
    arrive(("c", 2000))
    _, net = arrive(("a", 61), ("c", 2010))  # a's event is behind the watermark by now
    assert net == [("a", 0, 60, 4), ("b", 5, 5, 1), ("b", 35, 35, 1), ("c", 2000, 2010, 2)]


def test_users_come_to_the_state_many_at_a_time(spark):
    """No call to the state store for each user: state goes with the rows. Sessions out of reach leave it."""
    source, path, checkpoint = (fresh_path(spark, n) for n in ("clicks", "sessions", "checkpoint"))
    schema = ddl(CLICK)
    for rows in ((("a", 0), (None, 3), (None, 20)), (("b", 2000),), ((None, 2010),)):
        clicks(spark, *rows).coalesce(1).write.mode("append").parquet(source)
        changes = session_updates.stream_session_updates(read_event_files(spark, source, schema), "user", "at", dt.timedelta(minutes=30), "5 hours")
        session_updates.store_session_changes(spark, changes, path, checkpoint)
    assert "FlatMapGroupsInPandasWithState" in changes._jdf.queryExecution().analyzed().toString()
    rows = session_updates.net_sessions(session_updates.read_session_changes(spark, path, changes.schema), "user").collect()
    assert sorted((r.user or "", r.events) for r in rows) == [("", 1), ("", 2), ("a", 1), ("b", 1)]
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", session_updates.ROCKSDB)
    try:
        assert spark.read.format("statestore").load(checkpoint).count() == 2  # b, and nobody's last session
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass") if before is None else spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_numbered_users_and_those_without_a_number(spark):
    """Events of no user are a user's like any other, and count once."""
    source, path, checkpoint = (fresh_path(spark, n) for n in ("clicks", "sessions", "checkpoint"))
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 600)
    events = spark.range(1200).select(F.when(F.col("id") % 7 != 0, F.col("id") % 40).alias("user"), at.alias("at"))
    for part in range(3):
        events.filter(F.hour("at") % 3 == part).coalesce(1).write.mode("append").parquet(source)
    changes = session_updates.stream_session_updates(read_event_files(spark, source, events.schema, files_per_batch=1), "user", "at", lateness="60 days")
    session_updates.store_session_changes(spark, changes, path, checkpoint)
    net = session_updates.net_sessions(session_updates.read_session_changes(spark, path, changes.schema), "user")
    counted = {r.user: r.n for r in net.groupBy("user").agg(F.sum("events").alias("n")).collect()}
    assert counted == {r.user: r["count"] for r in events.groupBy("user").count().collect()}
