"""Queries over table layouts: each writes a table, reads it back and returns what it holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.operators.gold import filtered_revenue
from oreline.plans.stored import stored
from oreline.plans.views import EVENTS, GEO, ORDERS, WEB_ORDERS
from oreline.scratch import fresh_path
from oreline.sources import model
from oreline.sources.jobs import expensive_jobs as job_report
from oreline.sources.layout import (
    ByDate,
    ByIntRange,
    ByLoadDate,
    ByTimestampDate,
    estimate_scan,
    expire_partitions as drop_expired,
    logical_sizes,
    partition_stats as stats_report,
    read_partitioned,
    write_partitioned,
)
from oreline.sources.schemas import (
    CUSTOMERS_RANGE_PARTITIONED,
    EVENTS_PARTITIONED,
    ORDERS_OPTIMISED,
    ORDERS_PARTITIONED,
    RAW_EVENTS,
)

BY_DAY = ByDate("order_date")
BY_MONTH = ByDate("order_date", unit="month")
BY_YEAR = ByDate("order_date", unit="year")
DAYS_ASKED = ("2024-01-05", "2024-01-25")
KEEP_DAYS, EXPIRED_AS_OF, MONTHS_EXPIRED_AS_OF = 14, "2024-01-31", "2024-02-24"
REGION = "ASIA"
COLUMNS_ASKED = ("order_id", "region", "order_amount", "order_date")
SORT = ("region", "order_status", "product_category")


def _write_orders(spark: SparkSession, root: str, path: str) -> None:
    write_partitioned(model.web_orders(spark, root), path, BY_DAY, schema=ORDERS_PARTITIONED)


def _with_ntz(df: DataFrame, column: str) -> DataFrame:
    """A time without a zone, as the oracle has it."""
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def _orders_by_day(spark: SparkSession, root: str) -> str:
    return stored(spark, root, "orders-by-day", lambda path: _write_orders(spark, root, path))


def _clustered_orders(spark: SparkSession, root: str) -> str:
    def write(path: str) -> None:
        # Row groups well below a file's size, so that sorted files have some to skip.
        write_partitioned(model.orders(spark, root), path, BY_YEAR, SORT, schema=ORDERS_OPTIMISED, row_group_bytes=256 << 10)

    return stored(spark, root, "orders-clustered", write)


def partition_by_date(spark: SparkSession, root: str) -> DataFrame:
    path = fresh_path(spark, "by-date")
    _write_orders(spark, root, path)
    return _with_ntz(read_partitioned(spark, path, BY_DAY, require=False), "created_at")


def partition_by_event_ts(spark: SparkSession, root: str) -> DataFrame:
    """Some events come without a time; they are in a partition of their own."""
    layout, path = ByTimestampDate("event_timestamp"), fresh_path(spark, "by-event-ts")
    timed = F.when(F.col("event_id").cast("bigint") % 97 != 0, F.col("event_timestamp"))
    events = model.events(spark, root).withColumn("event_timestamp", timed)
    write_partitioned(events, path, layout, schema=EVENTS_PARTITIONED)
    return _with_ntz(read_partitioned(spark, path, layout, require=False), "event_timestamp")


def partition_by_ingestion(spark: SparkSession, root: str) -> DataFrame:
    """Two loads, the second appended to the first."""
    path, raw = fresh_path(spark, "by-load"), model.raw_events(spark, root)
    early = F.col("_ingestion_ts") < F.lit("2024-01-16").cast("timestamp")
    write_partitioned(raw.filter(early), path, ByLoadDate("2024-01-16"), schema=RAW_EVENTS)
    write_partitioned(raw.filter(~early), path, ByLoadDate("2024-01-31"), schema=RAW_EVENTS, mode="append")
    loads = read_partitioned(spark, path, ByLoadDate(), between=("2024-01-16", "2024-01-31"))
    return _with_ntz(loads, "_ingestion_ts")


def partition_by_int_range(spark: SparkSession, root: str) -> DataFrame:
    layout, path = ByIntRange("customer_id"), fresh_path(spark, "by-int")
    write_partitioned(model.customers_by_id(spark, root), path, layout, schema=CUSTOMERS_RANGE_PARTITIONED)
    return read_partitioned(spark, path, layout, require=False).withColumn(
        "id_bucket", F.col("id_bucket").cast("bigint")
    )


def clustered_scan(spark: SparkSession, root: str) -> DataFrame:
    path = _clustered_orders(spark, root)
    orders = read_partitioned(spark, path, BY_YEAR, between=("1996-01-15", "2000-12-31"))
    return filtered_revenue(orders, REGION, "COMPLETED")


def guarded_partition_scan(spark: SparkSession, root: str) -> DataFrame:
    orders = read_partitioned(spark, _orders_by_day(spark, root), BY_DAY, between=DAYS_ASKED)
    return orders.groupBy("order_date").agg(F.count("*").alias("orders"), F.sum("order_amount").alias("revenue"))


def expire_partitions(spark: SparkSession, root: str) -> DataFrame:
    path = fresh_path(spark, "expiring")
    _write_orders(spark, root, path)
    drop_expired(spark, path, BY_DAY, KEEP_DAYS, EXPIRED_AS_OF)
    return _with_ntz(spark.read.parquet(path), "created_at")


def expire_month_partitions(spark: SparkSession, root: str) -> DataFrame:
    """The cut lies inside a month, which stays whole."""
    path = fresh_path(spark, "expiring-months")
    write_partitioned(model.web_orders(spark, root), path, BY_MONTH, schema=ORDERS_PARTITIONED)
    drop_expired(spark, path, BY_MONTH, KEEP_DAYS, MONTHS_EXPIRED_AS_OF)
    return _with_ntz(spark.read.parquet(path).drop(BY_MONTH.partition_column), "created_at")


def partition_stats(spark: SparkSession, root: str) -> DataFrame:
    table = spark.read.parquet(_orders_by_day(spark, root))
    return stats_report(table, "order_date").select("partition_id", "total_rows")


def scan_cost_estimate(spark: SparkSession, root: str) -> DataFrame:
    """Price of a query that reads four columns of some days."""
    orders = spark.read.schema(ORDERS_PARTITIONED).parquet(_orders_by_day(spark, root))
    return estimate_scan(logical_sizes(orders, "order_date", COLUMNS_ASKED), F.col("order_date").between(*DAYS_ASKED))


def expensive_jobs(spark: SparkSession, root: str) -> DataFrame:
    report = job_report(model.jobs(spark, root), as_of="2024-01-31 00:00:00")
    return _with_ntz(report, "creation_time")


QUERIES = {
    "partition_by_date": partition_by_date,
    "partition_by_event_ts": partition_by_event_ts,
    "partition_by_ingestion": partition_by_ingestion,
    "partition_by_int_range": partition_by_int_range,
    "clustered_scan": clustered_scan,
    "guarded_partition_scan": guarded_partition_scan,
    "expire_partitions": expire_partitions,
    "expire_month_partitions": expire_month_partitions,
    "partition_stats": partition_stats,
    "scan_cost_estimate": scan_cost_estimate,
    "expensive_jobs": expensive_jobs,
}

ORACLE = {
    "partition_by_date": f"with {WEB_ORDERS} select * from web_orders",
    "partition_by_event_ts": f"""
        with {EVENTS},
        timed as (
          select * replace (case when cast(event_id as bigint) % 97 = 0 then null else event_timestamp end
                            as event_timestamp) from events_all
        )
        select *, cast(event_timestamp as date) as event_date from timed""",
    "partition_by_ingestion": """
        select props as raw_payload, event_type as source_system, cast(ts as timestamp) as _ingestion_ts,
               case when ts < timestamp '2024-01-16' then date '2024-01-16' else date '2024-01-31' end as _partitiondate
        from events""",
    "partition_by_int_range": f"""
        with {GEO}
        select case when c_custkey % 50 = 1 then -7000 else 7000 end * c_custkey as customer_id,
               c_name as customer_name, n_name as city, c_mktsegment as segment,
               cast(date '2024-01-01' + c_nationkey as date) as created_date,
               cast(case when c_custkey % 50 = 1 then 0 when c_custkey * 7000 >= 10000000 then 21
                    else c_custkey * 7000 // 500000 + 1 end as bigint) as id_bucket
        from customer join geo on c_nationkey = n_nationkey""",
    "clustered_scan": f"""
        with {ORDERS}
        select cast(sum(order_amount) as decimal(28,2)) as revenue, count(*) as orders from orders_all
        where order_date between date '1996-01-15' and date '2000-12-31'
          and region = '{REGION}' and order_status = 'COMPLETED'""",
    "guarded_partition_scan": f"""
        with {WEB_ORDERS}
        select order_date, count(*) as orders, cast(sum(order_amount) as decimal(28,2)) as revenue from web_orders
        where order_date between date '{DAYS_ASKED[0]}' and date '{DAYS_ASKED[1]}' group by order_date""",
    "expire_partitions": f"""
        with {WEB_ORDERS} select * from web_orders
        where order_date is null or order_date >= date '{EXPIRED_AS_OF}' - {KEEP_DAYS}""",
    "expire_month_partitions": f"""
        with {WEB_ORDERS} select * from web_orders
        where order_date is null or last_day(order_date) >= date '{MONTHS_EXPIRED_AS_OF}' - {KEEP_DAYS}""",
    "partition_stats": f"""
        with {WEB_ORDERS}
        select cast(order_date as varchar) as partition_id, count(*) as total_rows from web_orders
        group by order_date order by order_date desc nulls last limit 30""",
    "scan_cost_estimate": f"""
        with {WEB_ORDERS},
        priced as (
          select order_date, sum(coalesce(2 + strlen(order_id), 0) + coalesce(2 + strlen(region), 0)
                   + case when order_amount is null then 0 else 16 end + 8) as total_bytes
          from web_orders where order_date between date '{DAYS_ASKED[0]}' and date '{DAYS_ASKED[1]}' group by order_date
        )
        select count(*) as partitions, cast(sum(total_bytes) as bigint) as bytes_scanned,
               round(sum(total_bytes) / 1e12 * 5.0, 6) as estimated_cost from priced""",
    "expensive_jobs": """
        select cast(event_id as varchar) as job_id, user_id || '@example.com' as user_email,
               round(event_id * 104857600 / pow(1024, 3), 2) as gb_processed,
               round((event_id * 104857600 + 10485760) / pow(1024, 3), 2) as gb_billed,
               round(event_id * 137 / 1000.0, 1) as slot_seconds,
               cast(ts as timestamp) as creation_time,
               substr('SELECT * FROM events WHERE props = ''' || repeat(props, 10) || '''', 1, 100) as query_preview
        from events
        where ts >= timestamp '2024-01-31 00:00:00' - interval 7 day
          and event_type not in ('signup', 'error')
        order by event_id desc limit 20""",
}
