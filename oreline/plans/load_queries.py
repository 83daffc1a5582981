"""Incremental load queries and the streamed Bronze ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline.operators import incremental as inc
from oreline.operators.merge import Batch, mark_deleted, merge_upsert as upsert, unique_batch
from oreline.plans.views import EVENTS, LOADED_UNTIL, MERGED, ORDERS, RUN_TS
from oreline.scratch import fresh_path
from oreline.sources import model
from oreline.sources.files import data_files
from oreline.sources.layout import ByDate, write_partitioned
from oreline.sources.publish import read_declared
from oreline.sources.schemas import ORDERS_SILVER, PIPELINE_WATERMARKS, RAW, conform
from oreline.streaming.events import read_event_files, stream_sessions as sessions_of, stream_to_dates, stream_upsert as upsert_stream

KEY = ["order_id"]


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Times without a zone, as the oracle has them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _batch(spark: SparkSession, root: str) -> Batch:
    """The changes of the load window, written once for the steps that read them."""
    return unique_batch(inc.extract_batch(model.orders_source(spark, root), LOADED_UNTIL, RUN_TS), KEY)


def _merged(spark: SparkSession, root: str, batch: Batch) -> DataFrame:
    before = model.orders_before(spark, root, LOADED_UNTIL)
    stamps = {"_ingestion_date": F.lit(RUN_TS).cast("date"), "_silver_updated_at": F.current_timestamp()}
    return upsert(before, batch, KEY, stamps=stamps)


def _watermarks(spark: SparkSession, root: str) -> DataFrame:
    """Watermarks after the last load: one per region, at its latest loaded change."""
    state = model.orders_before(spark, root, LOADED_UNTIL).groupBy("region").agg(
        F.max("updated_at").alias("last_processed_ts"), F.count("*").alias("records_processed")
    )
    rows = state.select(
        F.concat(F.lit("orders_"), "region").alias("pipeline_name"),
        "last_processed_ts",
        F.lit(LOADED_UNTIL).cast("timestamp").alias("last_run_ts"),
        "records_processed",
        F.lit("manual_init").alias("updated_by"),
    )
    return conform(rows, PIPELINE_WATERMARKS)


def watermark_init(spark: SparkSession, root: str) -> DataFrame:
    """A watermark per region exists; add one per order status, at its first change."""
    seeds = model.orders(spark, root).groupBy("order_status").agg(F.min("updated_at").alias("last_processed_ts"))
    named = seeds.select(F.concat(F.lit("orders_"), "order_status").alias("pipeline_name"), "last_processed_ts")
    marks = inc.seed_watermarks(_watermarks(spark, root), named)
    return _ntz(marks.drop("last_run_ts"), "last_processed_ts")


def watermark_advance(spark: SparkSession, root: str) -> DataFrame:
    batch = _batch(spark, root)
    region = "ASIA"
    loaded = batch.table.filter(F.col("region") == region).count()
    marks = inc.advance_watermark(
        _watermarks(spark, root), f"orders_{region}", RUN_TS, loaded, "orders_incremental_job"
    )
    return _ntz(marks.drop("last_run_ts"), "last_processed_ts")


def incremental_extract(spark: SparkSession, root: str) -> DataFrame:
    source = model.orders_source(spark, root)
    return _ntz(inc.extract_batch(source, LOADED_UNTIL, RUN_TS), "updated_at")


def merge_upsert(spark: SparkSession, root: str) -> DataFrame:
    merged = _merged(spark, root, _batch(spark, root))
    return _ntz(merged.drop("_silver_updated_at"), "updated_at")


def merge_latest_wins(spark: SparkSession, root: str) -> DataFrame:
    """The feed has an order as placed and as settled; the settled one is later."""
    source = model.orders_source(spark, root)
    placed = source.withColumns(
        {"order_status": F.lit("PENDING"), "updated_at": F.col("order_date").cast("timestamp")}
    )
    feed = inc.extract_batch(source.unionByName(placed), LOADED_UNTIL, "2001-01-01 00:00:00")
    before = model.orders_before(spark, root, LOADED_UNTIL).drop("_silver_updated_at", "_ingestion_date")
    return _ntz(upsert(before, feed, KEY, on_duplicate="latest"), "updated_at")


BY_YEAR = ByDate("order_date", unit="year")
SILVER_SORT = ("region", "order_status")
HALFWAY = "1999-06-30 00:00:00"


def stored_orders(spark: SparkSession, root: str) -> str:
    """Path of Silver as the earlier load left it, one partition per year."""
    path = fresh_path(spark, "silver-orders")
    write_partitioned(BY_YEAR.assign(model.orders_before(spark, root, LOADED_UNTIL)), path, BY_YEAR, SILVER_SORT, ORDERS_SILVER)
    return path


def _two_runs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Two windows in a row over the stored table and its watermark; both as they are stored then."""
    silver, marks = stored_orders(spark, root), fresh_path(spark, "watermarks")
    seeds = spark.createDataFrame([("orders", LOADED_UNTIL)], "pipeline_name string, ts string")
    seeds = seeds.select("pipeline_name", F.col("ts").cast("timestamp").alias("last_processed_ts"))
    inc.store_watermarks(inc.seed_watermarks(inc.read_watermarks(spark, marks), seeds, now=LOADED_UNTIL), marks)
    for until in (HALFWAY, RUN_TS):
        inc.run_pipeline(
            spark, "orders", BY_YEAR.assign(model.orders_source(spark, root)), marks, until, "orders_incremental_job",
            now=until, target_path=silver, partition_column=BY_YEAR.partition_column, keys=KEY, run_date=until[:10],
            schema=ORDERS_SILVER, sort_by=SILVER_SORT,
        )
    return read_declared(spark, silver, ORDERS_SILVER), inc.read_watermarks(spark, marks)


def incremental_run(spark: SparkSession, root: str) -> DataFrame:
    return _ntz(_two_runs(spark, root)[0], "updated_at", "_silver_updated_at")


def incremental_run_marks(spark: SparkSession, root: str) -> DataFrame:
    return _ntz(_two_runs(spark, root)[1], "last_processed_ts", "last_run_ts")


def soft_delete(spark: SparkSession, root: str) -> DataFrame:
    """The source no longer has cancelled orders."""
    before = model.orders_before(spark, root, LOADED_UNTIL).select("order_id", "order_status", "order_amount")
    snapshot = model.orders_source(spark, root).filter(F.col("order_status") != "CANCELLED")
    return mark_deleted(before, snapshot, KEY)


def reconciliation(spark: SparkSession, root: str) -> DataFrame:
    batch = _batch(spark, root)
    source = model.orders_source(spark, root)
    return inc.reconcile(source, batch.table, _merged(spark, root, batch), KEY, LOADED_UNTIL, RUN_TS)


def stream_bronze_events(spark: SparkSession, root: str) -> DataFrame:
    """Stream the event file into date partitions and read the result."""
    path, checkpoint = fresh_path(spark, "bronze"), fresh_path(spark, "bronze-checkpoint")
    arriving = read_event_files(spark, root, RAW["events"], pattern="events.parquet").select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.col("user_id").cast("string").alias("user_id"),
        F.col("props").alias("event_payload"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
    )
    stream_to_dates(arriving, path, checkpoint).awaitTermination()
    return _ntz(spark.read.parquet(path), "event_timestamp")


MICRO_BATCHES = 4


def stream_upsert(spark: SparkSession, root: str) -> DataFrame:
    """Changes of orders out of order over several files and micro-batches: the latest change of a key stays.

    A micro-batch rewrites the partitions it touches, here all of them. So their number is fixed: the more files the
    changes lie in, the more of them a micro-batch takes.
    """
    path, arriving, checkpoint = (fresh_path(spark, n) for n in ("silver-stream", "changes", "changes-checkpoint"))
    changes = BY_YEAR.assign(model.orders_source(spark, root))
    early = changes.withColumns({"order_status": F.lit("PENDING"), "updated_at": F.col("order_date").cast("timestamp")})
    odd = F.col("order_id").cast("bigint") % 2 == 1
    for part in (changes.filter(odd).unionByName(early.filter(~odd)), early.filter(odd).unionByName(changes.filter(~odd))):
        part.write.mode("append").parquet(arriving)
    schema = StructType([f for f in ORDERS_SILVER.fields if f.name in (*changes.columns, "_ingestion_date", "_silver_updated_at")])
    files_per_batch = max(1, -(-len(data_files(spark, arriving)) // MICRO_BATCHES))
    stream = read_event_files(spark, arriving, changes.schema, files_per_batch=files_per_batch)
    upsert_stream(stream, path, BY_YEAR.partition_column, KEY, checkpoint, schema, SILVER_SORT, run_date="2002-01-01").awaitTermination()
    return _ntz(read_declared(spark, path, schema).drop("_silver_updated_at"), "updated_at")


def stream_sessions(spark: SparkSession, root: str) -> DataFrame:
    """Sessions the watermark has closed, two hours before the last event."""
    sink, checkpoint = fresh_path(spark, "sessions"), fresh_path(spark, "sessions-checkpoint")
    events = read_event_files(spark, root, RAW["events"], pattern="events.parquet")
    timed = events.select("user_id", F.col("ts").cast("timestamp").alias("at"))
    writer = sessions_of(timed, "user_id", "at").writeStream.format("parquet").option("path", sink)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    last = model.raw(spark, root, "events").agg(F.max("ts")).first()[0]
    closed = spark.read.parquet(sink).filter(F.col("session_end") < F.lit(str(last)).cast("timestamp") - F.expr("INTERVAL 2 hours"))
    return _ntz(closed, "session_start", "session_end")


QUERIES = {
    "watermark_init": watermark_init,
    "watermark_advance": watermark_advance,
    "incremental_extract": incremental_extract,
    "merge_upsert": merge_upsert,
    "merge_latest_wins": merge_latest_wins,
    "soft_delete": soft_delete,
    "reconciliation": reconciliation,
    "incremental_run": incremental_run,
    "incremental_run_marks": incremental_run_marks,
    "stream_bronze_events": stream_bronze_events,
    "stream_upsert": stream_upsert,
    "stream_sessions": stream_sessions,
}

_MARKS = """marks as (
  select 'orders_' || region as pipeline_name, max(updated_at) as last_processed_ts,
         count(*) as records_processed, 'manual_init' as updated_by
  from before group by region
)"""
_SEEDS = """seeds as (
  select 'orders_' || order_status as pipeline_name, min(updated_at) as last_processed_ts
  from orders_all group by order_status
)"""

ORACLE = {
    "watermark_init": f"""
        with {MERGED}, {_MARKS}, {_SEEDS}
        select * from marks
        union all
        select pipeline_name, last_processed_ts, cast(0 as bigint), 'manual_init' from seeds
        where pipeline_name not in (select pipeline_name from marks)""",
    "watermark_advance": f"""
        with {MERGED}, {_MARKS}
        select pipeline_name,
               case when pipeline_name = 'orders_ASIA' then timestamp '{RUN_TS}' else last_processed_ts end
                 as last_processed_ts,
               case when pipeline_name = 'orders_ASIA' then (select count(*) from batch where region = 'ASIA')
                    else records_processed end as records_processed,
               case when pipeline_name = 'orders_ASIA' then 'orders_incremental_job' else updated_by end as updated_by
        from marks""",
    "incremental_extract": f"with {MERGED} select * from batch",
    "merge_upsert": f"with {MERGED} select * from merged",
    "merge_latest_wins": f"""
        with {MERGED},
        feed as (
          select * from (
            select * exclude (product_category) from orders_all
            union all
            select order_id, customer_id, product_id, order_amount, 'PENDING' as order_status, order_date, region,
                   cast(order_date as timestamp) as updated_at
            from orders_all
          )
          where updated_at > timestamp '{LOADED_UNTIL}' and updated_at <= timestamp '2001-01-01 00:00:00'
          qualify row_number() over (partition by order_id order by updated_at desc) = 1
        )
        select f.order_id, f.customer_id, f.product_id, f.order_amount, f.order_status, f.order_date, f.region,
               t.product_category, f.updated_at
        from feed f left join before t on t.order_id = f.order_id
        union all
        select * from before where order_id not in (select order_id from feed)""",
    "soft_delete": f"""
        with {MERGED}
        select order_id, order_status, order_amount,
               order_id not in (select order_id from orders_all where order_status != 'CANCELLED') as is_deleted
        from before""",
    "reconciliation": f"""
        with {MERGED},
        counts as (
          select (select count(*) from orders_all where updated_at > timestamp '{LOADED_UNTIL}'
                    and updated_at <= timestamp '{RUN_TS}') as source_records,
                 (select count(*) from batch) as loaded_records,
                 (select count(distinct order_id) from merged where order_id in (select order_id from batch))
                   as target_records
        )
        select *, source_records - loaded_records as discrepancy,
               case when source_records = loaded_records then 'PASS'
                    else 'FAIL — investigate before proceeding' end as reconciliation_status
        from counts""",
    "incremental_run": f"""
        with {MERGED}
        select * exclude (_ingestion_date), cast(date_trunc('year', order_date) as date) as order_date_year,
               case when order_id not in (select order_id from batch) then date '1998-01-01'
                    when updated_at <= timestamp '{HALFWAY}' then date '{HALFWAY[:10]}'
                    else date '{RUN_TS[:10]}' end as _ingestion_date,
               case when order_id not in (select order_id from batch) then timestamp '{LOADED_UNTIL}'
                    when updated_at <= timestamp '{HALFWAY}' then timestamp '{HALFWAY}'
                    else timestamp '{RUN_TS}' end as _silver_updated_at
        from merged""",
    "incremental_run_marks": f"""
        with {MERGED}
        select 'orders' as pipeline_name, timestamp '{RUN_TS}' as last_processed_ts, timestamp '{RUN_TS}' as last_run_ts,
               (select count(*) from batch where updated_at > timestamp '{HALFWAY}') as records_processed,
               'orders_incremental_job' as updated_by""",
    "stream_upsert": f"""
        with {ORDERS}
        select * exclude (product_category), cast(date_trunc('year', order_date) as date) as order_date_year,
               date '2002-01-01' as _ingestion_date
        from orders_all""",
    "stream_sessions": """
        with flagged as (
          select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minute
                                   then 0 else 1 end as opens from events
        ),
        numbered as (select *, sum(opens) over (partition by user_id order by ts) as n from flagged),
        sessions as (select user_id, n, min(ts) as session_start, max(ts) as session_end, count(*) as events
                     from numbered group by user_id, n)
        select user_id, cast(session_start as timestamp) as session_start, cast(session_end as timestamp) as session_end,
               events from sessions where session_end < (select max(ts) from events) - interval 2 hour""",
    "stream_bronze_events": f"with {EVENTS} select *, cast(event_timestamp as date) as event_date from events_all",
}
