"""Exactly-once ingest of events by their id, with a side table for those that come too late."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from oreline.sources.publish import append_once, read_declared
from oreline.streaming.events import batch_token

DATE = "event_date"


def stream_dedup(
    events: DataFrame, path: str, checkpoint: str, event_id: str = "event_id", ts: str = "event_timestamp", lateness: str = "1 day"
) -> StreamingQuery:
    """Append each event once to date partitions; copies within ``lateness`` of each other are dropped.

    The ids seen are state that Spark keeps in the checkpoint and forgets once the watermark has passed them, so
    its size follows the events of ``lateness`` and not the history. Events behind the watermark are not written:
    ``stream_late`` keeps them.
    """
    once = events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([event_id])
    return (
        once.withColumn(DATE, F.to_date(ts))
        .writeStream.format("parquet")
        .partitionBy(DATE)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_late(
    events: DataFrame, path: str, late_path: str, checkpoint: str, schema: StructType, event_id: str = "event_id", ts: str = "event_timestamp"
) -> StreamingQuery:
    """Keep the events that the main table at ``path`` does not have, each once, in a table of their own.

    Reads the same source after ``stream_dedup`` has ended its run. An event is late if its id is neither in the
    main table nor in the side table; both are read for the dates of the micro-batch only. A micro-batch that is
    delivered again is written once.
    """
    stored = StructType([*schema.fields, StructField(DATE, DateType())])

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = batch.withColumn(DATE, F.to_date(ts)).dropDuplicates([event_id])
        dates = [r[0] for r in dated.select(DATE).distinct().collect()]
        known = F.col(DATE).isin([d for d in dates if d is not None]) | F.col(DATE).isNull()
        for table in (path, late_path):
            held = read_declared(spark, table, stored).filter(known).select(event_id)
            dated = dated.join(held, event_id, "left_anti")
        append_once(dated.select(*stored.names), late_path, DATE, batch_token(spark, checkpoint, batch_id))

    return events.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def all_events(spark: SparkSession, path: str, late_path: str, schema: StructType, event_id: str = "event_id") -> DataFrame:
    """Both tables as one, with ``is_late``. An event that reached the main table after all is not late."""
    stored = StructType([*schema.fields, StructField(DATE, DateType())])
    main = read_declared(spark, path, stored)
    late = read_declared(spark, late_path, stored).join(main.select(event_id), event_id, "left_anti")
    return main.withColumn("is_late", F.lit(False)).unionByName(late.withColumn("is_late", F.lit(True)))
