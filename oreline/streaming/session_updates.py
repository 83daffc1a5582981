"""Sessions of a stream as they become known, taken back and corrected when late events join or extend them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegerType, LongType, StructField, StructType, TimestampType

from oreline.sources.publish import append_once, read_declared
from oreline.streaming.events import batch_token

#: Change of a row of the output: a session that holds from now on, or one that holds no more.
HOLDS, TAKEN_BACK = 1, -1
_US = 1_000_000


def merge_spans(start: np.ndarray, end: np.ndarray, events: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of activity joined where less than ``gap`` lies between them; sorted by start."""
    order = np.argsort(start, kind="stable")
    start, end, events = start[order], end[order], events[order]
    reach = np.maximum.accumulate(end) if len(end) else end
    first = np.flatnonzero(np.append(True, start[1:] - reach[:-1] >= gap)) if len(start) else np.empty(0, np.int64)
    last = np.append(first[1:], len(start)) - 1 if len(first) else first
    return start[first], reach[last], np.add.reduceat(events, first) if len(first) else events


def _fragments(user: str, gap: int):
    """Function that folds the events of a batch into spans, so that a busy user sends few rows to the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # All users of the batch at once: in order of user and time, a span begins at a new user or after a pause.
            codes, _ = pd.factorize(batch[user], use_na_sentinel=False)
            at = batch["_at"].to_numpy(np.int64)
            order = np.lexsort((at, codes))
            codes, at = codes[order], at[order]
            begins = np.ones(len(at), bool)
            begins[1:] = (codes[1:] != codes[:-1]) | (at[1:] - at[:-1] >= gap)
            first = np.flatnonzero(begins)
            last = np.append(first[1:], len(at))[: len(first)] - 1
            names = batch[user].iloc[order[first]].reset_index(drop=True)
            # The watermark looks at a span's last event: what is late as a span is late as events.
            columns = {"seen_at": pd.to_datetime(at[last], unit="us"), "span_start": at[first], "span_end": at[last], "span_events": last - first + 1}
            yield pd.DataFrame({user: names, **columns})

    return run


#: State of a user: the open spans, as lists of equal length.
SPANS = "start array<bigint>, end array<bigint>, events array<bigint>"


def _corrections(gap: int, user: str):
    """Function that joins a user's spans with the open ones and reports the sessions this changes.

    State is kept until the watermark says that no event can reach it. It comes and goes with the rows of the
    users, many at a time, so a user costs no calls of their own to the state store.
    """

    def changes(key, before: set, after: set) -> Iterator[pd.DataFrame]:
        rows = [(key[0], s, e, n, change) for spans, change in ((before - after, TAKEN_BACK), (after - before, HOLDS)) for s, e, n in sorted(spans)]
        if rows:
            names, starts, ends, events, change = zip(*rows)
            times = {"session_start": np.array(starts, "M8[us]"), "session_end": np.array(ends, "M8[us]")}
            yield pd.DataFrame({user: names, **times, "events": events, "change": np.array(change, np.int32)})

    def keep(spans: list, state: GroupState) -> None:
        """Hold the spans an event may still join, and a timeout for when the first of them is out of reach."""
        watermark_ms = state.getCurrentWatermarkMs()
        beyond = lambda span: (span[1] + gap) // 1000 + 1
        left = [span for span in spans if beyond(span) > watermark_ms]
        if left:
            state.update(tuple(list(values) for values in zip(*left)))
            state.setTimeoutTimestamp(min(map(beyond, left)))
        else:
            state.remove()

    def run(key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(zip(*state.get)) if state.exists else []
        if state.hasTimedOut:
            keep(held, state)
            return
        parts = [np.stack([f[c].to_numpy(np.int64) for c in ("span_start", "span_end", "span_events")], 1) for f in rows]
        spans = np.concatenate([np.array(held, np.int64).reshape(-1, 3), *parts])
        after = list(zip(*(column.tolist() for column in merge_spans(spans[:, 0], spans[:, 1], spans[:, 2], gap))))
        yield from changes(key, set(held), set(after))
        keep(after, state)

    return run


def stream_session_updates(events: DataFrame, user: str, ts: str, gap: dt.timedelta = dt.timedelta(minutes=30), lateness: str = "1 hour") -> DataFrame:
    """``user, session_start, session_end, events, change``: every session when it is first seen, and when late
    or further events change it, the old form with ``change`` -1 and the new one with +1.

    The sum of ``change`` per session is at any time the sessions of all events so far, open ones included. Events
    later than ``lateness`` behind the newest are left out. The sink is written in update mode; a session that
    keeps state in RocksDB (``spark.sql.streaming.stateStore.providerClass``) holds it on disk. State is one list
    of open spans for each user, and a batch's events are folded into spans before they are shuffled.
    """
    micros = int(gap.total_seconds() * _US)
    kind = events.schema[user]
    dated = events.select(user, F.unix_micros(ts).alias("_at")).where(F.col("_at").isNotNull())
    spans = StructType([kind, StructField("seen_at", TimestampType()), *[StructField(c, LongType()) for c in ("span_start", "span_end", "span_events")]])
    folded = dated.mapInPandas(_fragments(user, micros), spans).withWatermark("seen_at", lateness)
    times = [StructField(c, TimestampType()) for c in ("session_start", "session_end")]
    out = StructType([kind, *times, StructField("events", LongType()), StructField("change", IntegerType())])
    return folded.groupBy(user).applyInPandasWithState(_corrections(micros, user), out, SPANS, "update", GroupStateTimeout.EventTimeTimeout)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def store_session_changes(spark: SparkSession, changes: DataFrame, path: str, checkpoint: str) -> None:
    """Append the changes of all arrived input to a table by kind of change; each micro-batch is there once.

    Sets the state provider that keeps state on disk while the query runs.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        append_once(batch, path, "change", batch_token(batch.sparkSession, checkpoint, batch_id))

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        writer = changes.writeStream.foreachBatch(land).outputMode("update").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def read_session_changes(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_declared(spark, path, schema)


def net_sessions(changes: DataFrame, user: str) -> DataFrame:
    """The sessions that hold after all changes."""
    return changes.groupBy(user, "session_start", "session_end", "events").agg(F.sum("change").alias("held")).filter("held > 0").drop("held")
