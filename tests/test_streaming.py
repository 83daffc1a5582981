import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline.operators.sessions import session_summary, sessionize
from oreline.plans import load_queries
from oreline.scratch import fresh_path
from oreline.sources import model
from oreline.sources.publish import read_declared
from oreline.sources.schemas import RAW
from oreline.streaming import events as event_streams
from oreline.streaming.events import read_event_files, stream_sessions, stream_to_dates, stream_upsert

SMALL = "/root/testdata/sf0.001"
RAW_EVENTS = RAW["events"]


def test_ingest_continues_where_it_stopped(spark):
    source, path, checkpoint = (fresh_path(spark, n) for n in ("arriving", "bronze", "checkpoint"))
    events = model.events(spark, SMALL)
    half = F.lit("2024-01-15").cast("timestamp")
    for part in (events.filter(F.col("event_timestamp") < half), events.filter(F.col("event_timestamp") >= half), None):
        if part is not None:
            part.repartition(8).write.mode("append").parquet(source)
        stream = read_event_files(spark, source, events.schema)
        stream_to_dates(stream, path, checkpoint).awaitTermination()
    bronze = spark.read.parquet(path)
    assert bronze.drop("event_date").exceptAll(events).isEmpty() and bronze.count() == events.count()
    assert bronze.filter(F.col("event_date") != F.to_date("event_timestamp")).isEmpty()
    files = bronze.select("event_date", "_metadata.file_path").distinct().groupBy("event_date").count()
    assert files.agg(F.max("count")).first()[0] <= 2  # the day of the cut is reached twice
    spark.createDataFrame([(None, "x", "u", "{}", dt.datetime(2024, 1, 1))], events.schema).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="NULL in NOT NULL column event_id"):
        stream_to_dates(read_event_files(spark, source, events.schema), path, checkpoint).awaitTermination()


def test_upsert_stream(spark):
    schema = "id string, amount int, day date, updated_at timestamp"
    stored = StructType.fromDDL("id string, amount int, updated_at timestamp, _ingestion_date date, day date")
    source, path, checkpoint = (fresh_path(spark, n) for n in ("changes", "silver", "checkpoint"))
    at = dt.datetime(2024, 1, 1)

    def rows(*values):
        return spark.createDataFrame([(i, a, dt.date(2024, 1, d), at + dt.timedelta(hours=h)) for i, a, d, h in values], schema)

    # The last change of "a" is older than what is stored: it must not win.
    for change in (rows(("a", 1, 1, 0)), rows(("a", 2, 1, 1), ("a", 3, 2, 5)), rows(("b", 5, 2, 3), ("a", 9, 1, 2))):
        change.write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        stream_upsert(stream, path, "day", ["id"], checkpoint, stored, run_date="2024-02-02").awaitTermination()
    found = read_declared(spark, path, stored).collect()
    assert {(r.id, r.amount, r.day.day) for r in found} == {("a", 3, 2), ("b", 5, 2)}
    assert {str(r._ingestion_date) for r in found} == {"2024-02-02"}


def test_closed_sessions_equal_the_batch_result(spark):
    source, checkpoint = fresh_path(spark, "arriving"), fresh_path(spark, "checkpoint")
    events = model.raw(spark, SMALL, "events")
    events.write.parquet(source)
    stream = read_event_files(spark, source, RAW_EVENTS).withColumn("at", F.col("ts").cast("timestamp"))
    sink = fresh_path(spark, "sessions")
    (
        stream_sessions(stream, "user_id", "at")
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    closed = spark.read.parquet(sink)
    batch = session_summary(
        sessionize(events.withColumn("at", F.col("ts").cast("timestamp")), "user_id", "at"), "user_id", "at"
    ).drop("session_no")
    last = batch.agg(F.max("session_end")).first()[0]
    done = batch.filter(F.col("session_end") < F.lit(last) - F.expr("INTERVAL 2 hours"))
    assert done.count() > 100
    assert done.exceptAll(closed.select(done.columns)).isEmpty()
    assert closed.select(done.columns).exceptAll(batch).isEmpty()


def test_many_files_are_few_micro_batches(spark, monkeypatch):
    """Every micro-batch rewrites the table: their number does not follow that of the files."""
    root = fresh_path(spark, "star")
    tables = {
        "region": spark.createDataFrame([(0, "ASIA")], RAW["region"]),
        "nation": spark.createDataFrame([(0, "N", 0)], RAW["nation"]),
        "customer": spark.range(20).selectExpr("id as c_custkey", "'c' as c_name", "0 as c_nationkey", "1.0D as c_acctbal", "'BUILDING' as c_mktsegment"),
        "orders": spark.range(600).selectExpr(
            "id as o_orderkey", "id % 20 as o_custkey", "'F' as o_orderstatus", "1.0D as o_totalprice",
            "timestamp_ntz'1999-01-01 00:00:00' as o_orderdate", "'1-URGENT' as o_orderpriority",
        ).repartition(12),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{root}/{name}.parquet")
    loads, real = [], event_streams.upsert_partitions
    monkeypatch.setattr(event_streams, "upsert_partitions", lambda *args, **options: loads.append(1) or real(*args, **options))
    found = load_queries.stream_upsert(spark, root)
    assert 2 <= len(loads) <= load_queries.MICRO_BATCHES
    assert found.count() == 600 and found.filter("order_status != 'COMPLETED'").isEmpty()
