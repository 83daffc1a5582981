"""Structured Streaming forms of the event ingest, the upsert and the sessions."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from oreline.functions.scalars import day
from oreline.operators.merge import upsert_partitions
from oreline.sources.files import read_text
from oreline.sources.publish import append_once
from oreline.sources.schemas import EVENTS_PARTITIONED, conform


def read_event_files(
    spark: SparkSession, path: str, schema: StructType | str, pattern: str | None = None, files_per_batch: int = 100
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def batch_token(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Name of a micro-batch that no other has: the id its query keeps in the checkpoint, and its number."""
    return f"{json.loads(read_text(spark, f'{checkpoint}/metadata'))['id']}-{batch_id}"


def stream_to_dates(
    events: DataFrame,
    path: str,
    checkpoint: str,
    schema: StructType = EVENTS_PARTITIONED,
    ts: str = "event_timestamp",
) -> StreamingQuery:
    """Append events to one partition per event date and stop when the input is used up.

    Events are held to ``schema``, NOT NULL columns included. Each micro-batch is rebalanced by date: small dates
    share a task and leave one file, a hot one is split over many tasks. A micro-batch that is delivered again
    after a failure goes on where it stopped and is there once.
    """
    dated = conform(events, schema).withColumn("event_date", F.to_date(ts))

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        append_once(batch, path, "event_date", batch_token(spark, checkpoint, batch_id))

    return _each_batch(dated, land, checkpoint)


def stream_upsert(
    changes: DataFrame,
    path: str,
    partition_column: str,
    keys: Sequence[str],
    checkpoint: str,
    schema: StructType,
    sort_by: tuple[str, ...] = (),
    changed_at: str = "updated_at",
    run_date=None,
    **options,
) -> StreamingQuery:
    """Upsert each micro-batch; the checkpoint takes the place of the watermark table.

    A batch can be delivered again after a failure, which the upsert allows for. Changes may come
    more than once and in any order, within a batch and across batches: the latest by
    ``changed_at`` wins. A micro-batch rewrites every partition it touches, so the source should
    deliver a share of the table at a time, not a file. Rows written are stamped like those of a batch load, if the table has
    the columns; ``run_date`` is the load date, by default the day of the batch.
    """
    stamps = {"_silver_updated_at": F.current_timestamp(), "_ingestion_date": F.current_date() if run_date is None else day(run_date)}
    settings = {
        "on_duplicate": "latest",
        "only_if_newer": changed_at,
        "stamps": {c: v for c, v in stamps.items() if c in schema.names},
        **options,
    }

    def upsert(batch: DataFrame, _batch_id: int) -> None:
        upsert_partitions(batch.sparkSession, path, partition_column, batch, keys, schema, sort_by, **settings)

    return _each_batch(changes, upsert, checkpoint)


def _each_batch(stream: DataFrame, action: Callable, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(action)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_sessions(events: DataFrame, user: str, ts: str, gap: str = "30 minutes", lateness: str = "1 hour") -> DataFrame:
    """Closed sessions of an event stream; events later than ``lateness`` are left out.

    ``ts`` must be a TIMESTAMP with zone. A pause of exactly ``gap`` ends a session here, as Spark's
    session windows are open above. With the session setting
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` the events of a busy
    user are reduced before the shuffle; it is the caller's to set.
    """
    return (
        events.withWatermark(ts, lateness)
        .groupBy(user, F.session_window(ts, gap).alias("session"))
        .agg(F.count("*").alias("events"), F.min(ts).alias("session_start"), F.max(ts).alias("session_end"))
        .select(user, "session_start", "session_end", "events")
    )
