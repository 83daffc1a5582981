"""Queries over tables kept in shape between loads: clustering, statistics, deltas, late changes, ledgers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from oreline.operators import drift, gold_delta, ledger, scd2_late
from oreline.operators.incremental import extract_batch, run_incremental
from oreline.operators.merge import delete_partitions, upsert_partitions
from oreline.operators.reconcile import key_bucket, reconcile_keys as differing_keys
from oreline.plans.analytic_queries import _mv
from oreline.plans.dimension_queries import BY_START, KEY, TRACKED, _business, _changes
from oreline.plans.layout_queries import ORACLE as LAYOUT_ORACLE
from oreline.plans.layout_queries import BY_YEAR, COLUMNS_ASKED, DAYS_ASKED, _orders_by_day
from oreline.plans.load_queries import SILVER_SORT, _ntz, stored_orders
from oreline.plans.stored import stored
from oreline.plans.views import DIM_0, EVENTS, LINES, LOADED_UNTIL, MERGED, ORDERS, RUN_TS, SILVER_1, SILVER_2, WEB_ORDERS
from oreline.scratch import fresh_path
from oreline.sources import clustering, model, statistics
from oreline.sources.layout import write_partitioned
from oreline.sources.publish import read_declared
from oreline.sources.schemas import (
    DIM_CUSTOMER,
    DIM_CUSTOMER_STORED,
    MONEY,
    ORDERS_OPTIMISED,
    ORDERS_PARTITIONED,
    ORDERS_SILVER,
    create_table,
)
from oreline.streaming import dedup, session_updates
from oreline.streaming.events import read_event_files

CLUSTER_COLUMNS = ("order_amount", "customer_id", "product_id")
ROWS_PER_FILE = 5000
YEAR_STORED = StructType([*ORDERS_OPTIMISED.fields, StructField(BY_YEAR.partition_column, ORDERS_OPTIMISED["order_date"].dataType)])


def _curved_orders(spark: SparkSession, root: str) -> str:
    def write(path: str) -> None:
        clustering.write_clustered(model.orders(spark, root), path, BY_YEAR, CLUSTER_COLUMNS, ROWS_PER_FILE, ORDERS_OPTIMISED)

    return stored(spark, root, "orders-curved", write)


FILTERS = {
    "amount": "order_amount between 100000 and 105000",
    "customer": "customer_id = '100'",
    "product": "product_id = '17'",
}


def clustered_layout_scan(spark: SparkSession, root: str) -> DataFrame:
    """One filter on each clustered column of the same table."""
    orders = spark.read.schema(YEAR_STORED).parquet(_curved_orders(spark, root))

    def answer(name: str, picked: str) -> DataFrame:
        found = orders.filter(picked).agg(F.count("*").alias("orders"), F.sum("order_amount").alias("revenue"))
        return found.select(F.lit(name).alias("filtered_by"), "orders", F.col("revenue").cast("decimal(28,2)").alias("revenue"))

    first, *rest = [answer(name, picked) for name, picked in FILTERS.items()]
    for more in rest:
        first = first.unionByName(more)
    return first


SMALL_LOADS = 10


def recluster_partition(spark: SparkSession, root: str) -> DataFrame:
    """A table after one load, ten small ones, and upkeep: the same orders in files that overlap less."""
    path, arriving, orders = fresh_path(spark, "orders-upkeep"), fresh_path(spark, "orders-by-load"), model.orders(spark, root)
    # Each load reads its own orders only.
    slot = F.pmod(F.xxhash64("order_id"), F.lit(100))
    orders.withColumn("load", F.least(slot, F.lit(SMALL_LOADS)).cast("int")).write.partitionBy("load").parquet(arriving)
    arrived = spark.read.schema(StructType([*orders.schema.fields, StructField("load", IntegerType())])).parquet(arriving)
    for load in (SMALL_LOADS, *range(SMALL_LOADS)):
        rows = arrived.filter(F.col("load") == load).drop("load")
        clustering.write_clustered(rows, path, BY_YEAR, CLUSTER_COLUMNS, ROWS_PER_FILE, ORDERS_OPTIMISED)
    clustering.recluster(spark, path, YEAR_STORED, BY_YEAR.partition_column, ROWS_PER_FILE)
    return spark.read.schema(YEAR_STORED).parquet(path)


def _statistics(spark: SparkSession, root: str) -> DataFrame:
    """Statistics of the orders by day, kept by two loads: all days, then those of one week again."""
    table = _orders_by_day(spark, root)

    def write(path: str) -> None:
        refresh = lambda touched: statistics.refresh_statistics(spark, path, table, ORDERS_PARTITIONED, "order_date", ORDERS_PARTITIONED.names, touched)
        refresh(None)
        refresh([f"2024-01-{day:02}" for day in range(8, 15)])

    return statistics.read_statistics(spark, stored(spark, root, "orders-statistics", write))


def scan_cost_from_stats(spark: SparkSession, root: str) -> DataFrame:
    """Price of a query that reads four columns of some days, from stored statistics only."""
    return statistics.scan_cost_from_statistics(_statistics(spark, root), COLUMNS_ASKED, F.col(statistics.PARTITION).between(*DAYS_ASKED))


def table_profile_from_stats(spark: SparkSession, root: str) -> DataFrame:
    """Rows, missing values, bytes and bounds of every column of some days, from stored statistics only."""
    merged = statistics.table_statistics(_statistics(spark, root), F.col(statistics.PARTITION).between(*DAYS_ASKED))
    return merged.select("column_name", "partitions", "total_rows", "nulls", "total_bytes", "least", "greatest")


DELETED = "cast(order_id as bigint) % 50 = 0"


def mv_refresh_delta(spark: SparkSession, root: str) -> DataFrame:
    """The aggregate after a load that adds, changes and moves orders, and a removal, from their images alone."""
    path, silver = fresh_path(spark, "revenue-state"), stored_orders(spark, root)
    gold_delta.build_revenue_state(read_declared(spark, silver, ORDERS_SILVER), path, "start")
    changes = BY_YEAR.assign(extract_batch(model.orders_source(spark, root), LOADED_UNTIL, RUN_TS))
    settings = (["order_id"], ORDERS_SILVER, SILVER_SORT)
    load = upsert_partitions(spark, silver, BY_YEAR.partition_column, changes, *settings, images=gold_delta.IMAGE)
    gone = delete_partitions(spark, silver, BY_YEAR.partition_column, model.orders(spark, root).filter(DELETED), *settings, images=gold_delta.IMAGE)
    for name, images in (("load", load.images), ("removal", gone.images), ("removal", gone.images)):
        gold_delta.apply_revenue_changes(spark, path, images, name)
    return gold_delta.read_revenue_state(spark, path)


def scd2_late_changes(spark: SparkSession, root: str) -> DataFrame:
    """The changes of the second run come first, then those of the first, then corrections for the second's date."""
    dim, log = fresh_path(spark, "dim-late"), fresh_path(spark, "dim-log")
    initial = model.dim_customer_initial(spark, root)
    write_partitioned(initial, dim, BY_START, (KEY, "is_current"), DIM_CUSTOMER)
    scd2_late.seed_log(initial, log, KEY, TRACKED, DIM_CUSTOMER_STORED)

    def changes(run: str, recorded: str) -> DataFrame:
        silver = _changes(model.customers_silver(spark, root, run), run)
        dated = {"effective": F.lit(run).cast("date"), "recorded_at": F.lit(recorded).cast("timestamp")}
        return silver.select(KEY, *TRACKED).withColumns(dated)

    corrected = changes(model.SECOND_RUN, "2000-01-05").filter(F.col("customer_name").endswith(" II"))
    corrected = corrected.withColumn("customer_name", F.concat("customer_name", F.lit("I")))
    for batch in (changes(model.SECOND_RUN, "2000-01-02"), changes(model.FIRST_RUN, "1997-06-02"), corrected):
        scd2_late.splice_changes(spark, dim, log, batch, KEY, TRACKED, DIM_CUSTOMER_STORED, BY_START)
    return _business(read_declared(spark, dim, DIM_CUSTOMER_STORED)).drop(BY_START.partition_column)


RECONCILE_BUCKETS = 32


def reconcile_keys(spark: SparkSession, root: str) -> DataFrame:
    """Two copies of the orders by key bucket, of which one lacks, adds and changes some."""
    columns = ["order_id", "customer_id", "order_amount", "order_status", "order_date", "region"]
    orders = model.orders(spark, root).select(columns)
    number = F.col("order_id").cast("bigint")
    amount = F.when(number % 9973 == 7, F.lit(None).cast(MONEY)).when(number % 4999 == 3, F.col("order_amount") + 1).otherwise(F.col("order_amount"))
    status = F.when(number % 4999 == 3, "LOST").otherwise(F.col("order_status"))
    copy = orders.filter(number % 5003 != 1).withColumns({"order_amount": amount, "order_status": status})
    added = orders.filter(number % 7001 == 2).withColumn("order_id", F.concat(F.lit("x"), "order_id"))
    tables = []
    for name, rows in (("reconcile-source", orders), ("reconcile-target", copy.unionByName(added))):
        path = fresh_path(spark, name)
        rows.withColumn("key_bucket", key_bucket(["order_id"], RECONCILE_BUCKETS)).hint("rebalance", "key_bucket").write.partitionBy("key_bucket").parquet(path)
        tables.append(spark.read.schema(StructType([*rows.schema.fields, StructField("key_bucket", IntegerType())])).parquet(path))
    return differing_keys(*tables, ["order_id"], columns, stored_bucket="key_bucket").keys


def extract_by_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The source against a ledger of the earlier load; every thirteenth order of that time came after it."""
    source = model.orders_source(spark, root)
    loaded = model.orders_before(spark, root, LOADED_UNTIL).filter(F.col("order_id").cast("bigint") % 13 != 0)
    path, keys = fresh_path(spark, "ledger"), ["order_id"]
    first = ledger.extract_by_ledger(spark, loaded.select(source.columns), path, keys)
    ledger.store_ledger(spark, path, first, keys)
    return _ntz(ledger.extract_by_ledger(spark, source, path, keys).batch, "updated_at")


def create_orders_table(spark: SparkSession, root: str) -> DataFrame:
    """Orders inserted into a declared catalog table, created twice over."""
    name, path = f"orders_{uuid.uuid4().hex}", fresh_path(spark, "declared")
    for _ in range(2):
        create_table(spark, name, ORDERS_OPTIMISED, path, description="orders as served")
    rows = model.orders(spark, root).select(ORDERS_OPTIMISED.names)
    rows.write.mode("append").insertInto(name)
    return spark.table(name)


def incremental_run_twice(spark: SparkSession, root: str) -> DataFrame:
    """One window loaded twice over: the second run finds nothing left to do."""
    silver = stored_orders(spark, root)
    for _ in range(2):
        run_incremental(
            spark, BY_YEAR.assign(model.orders_source(spark, root)), silver, BY_YEAR.partition_column, ["order_id"],
            LOADED_UNTIL, RUN_TS, RUN_TS[:10], ORDERS_SILVER, SILVER_SORT, now=RUN_TS,
        )
    return _ntz(read_declared(spark, silver, ORDERS_SILVER).drop("_silver_updated_at", BY_YEAR.partition_column), "updated_at")


LATE_BEFORE, MIDDLE = "2024-01-11", "2024-01-21"


def stream_dedup_events(spark: SparkSession, root: str) -> DataFrame:
    """Events in files that come twice, after a restart, and long after their time: each once, and which were late."""
    arriving, path, late, *checkpoints = (fresh_path(spark, n) for n in ("arriving", "events", "late", "events-checkpoint", "late-checkpoint"))
    events = model.events(spark, root)
    early, middle = F.col("event_timestamp") < LATE_BEFORE, F.col("event_timestamp") < MIDDLE
    held_back = early & (F.col("event_id").cast("bigint") % 50 == 0)
    parts = [events.filter(~held_back & early), events.filter(~early & middle), events.filter(~middle), events.filter(held_back)]
    for files in ((parts[0], parts[1]), (parts[1], parts[2]), (parts[3],)):
        for rows in files:
            rows.coalesce(1).write.mode("append").parquet(arriving)
        stream = read_event_files(spark, arriving, events.schema)
        dedup.stream_dedup(stream, path, checkpoints[0]).awaitTermination()
        dedup.stream_late(stream, path, late, checkpoints[1], events.schema).awaitTermination()
    return _ntz(dedup.all_events(spark, path, late, events.schema), "event_timestamp")


FILES_ARRIVING = 12


def stream_session_updates(spark: SparkSession, root: str) -> DataFrame:
    """Events in three lots with gaps everywhere: what holds after all sessions taken back and corrected."""
    arriving, path, checkpoint = (fresh_path(spark, n) for n in ("arriving", "session-changes", "session-checkpoint"))
    events = model.raw(spark, root, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("at"))
    for third in range(3):
        # A lot is one micro-batch and lies in several files, so that many tasks read it.
        events.filter(F.col("event_id") % 3 == third).repartition(FILES_ARRIVING).write.mode("append").parquet(arriving)
    stream = read_event_files(spark, arriving, events.schema, files_per_batch=FILES_ARRIVING)
    changes = session_updates.stream_session_updates(stream, "user_id", "at", lateness="60 days")
    session_updates.store_session_changes(spark, changes, path, checkpoint)
    held = session_updates.net_sessions(session_updates.read_session_changes(spark, path, changes.schema), "user_id")
    return _ntz(held, "session_start", "session_end")


def dq_distribution_drift(spark: SparkSession, root: str) -> DataFrame:
    """Amounts of the order lines of every month against the month before."""
    lines = model.order_lines(spark, root)
    cuts = {"order_amount": drift.fit_cuts(lines, "order_amount")}
    found = drift.distribution_drift(drift.histograms(lines, F.trunc("_ingestion_date", "month"), cuts))
    checked = drift.drift_checks(found, "order_lines", "lines").select("run_date", "check_name", "severity", "status")
    return found.join(checked, "run_date")


QUERIES = {
    "clustered_layout_scan": clustered_layout_scan,
    "recluster_partition": recluster_partition,
    "scan_cost_from_stats": scan_cost_from_stats,
    "table_profile_from_stats": table_profile_from_stats,
    "mv_refresh_delta": mv_refresh_delta,
    "scd2_late_changes": scd2_late_changes,
    "reconcile_keys": reconcile_keys,
    "extract_by_ledger": extract_by_ledger,
    "create_orders_table": create_orders_table,
    "incremental_run_twice": incremental_run_twice,
    "stream_dedup_events": stream_dedup_events,
    "stream_session_updates": stream_session_updates,
    "dq_distribution_drift": dq_distribution_drift,
}

_OPTIMISED = "order_id, customer_id, product_id, order_amount, order_status, order_date, region, product_category"


def _profiled(column: str, width: str) -> str:
    text = lambda f: f"cast({f}({column}) as varchar)"
    return f"""
        select '{column}' as column_name, count(distinct order_date) as partitions, count(*) as total_rows,
               count(*) - count({column}) as nulls, cast(coalesce(sum({width}), 0) as bigint) as total_bytes,
               {text('min')} as least, {text('max')} as greatest from picked"""


_TEXT_WIDTH = "case when {0} is null then 0 else strlen({0}) + 2 end"

ORACLE = {
    "clustered_layout_scan": f"""
        with {ORDERS},
        answers as (
          select 'amount' as filtered_by, order_amount from orders_all where order_amount between 100000 and 105000
          union all select 'customer', order_amount from orders_all where customer_id = '100'
          union all select 'product', order_amount from orders_all where product_id = '17'
        )
        select filtered_by, count(*) as orders, cast(sum(order_amount) as decimal(28,2)) as revenue
        from answers group by filtered_by""",
    "recluster_partition": f"""
        with {ORDERS}
        select {_OPTIMISED}, cast(date_trunc('year', order_date) as date) as order_date_year from orders_all""",
    "scan_cost_from_stats": LAYOUT_ORACLE["scan_cost_estimate"],
    "table_profile_from_stats": f"""
        with {WEB_ORDERS},
        picked as (select * from web_orders where order_date between date '{DAYS_ASKED[0]}' and date '{DAYS_ASKED[1]}')
        {" union all ".join(_profiled(c, _TEXT_WIDTH.format(c)) for c in ("order_id", "customer_id", "product_id", "order_status", "region"))}
        union all {_profiled("order_amount", "case when order_amount is null then 0 else 16 end")}
        union all {_profiled("order_date", "case when order_date is null then 0 else 8 end")}
        union all {_profiled("created_at", "case when created_at is null then 0 else 8 end")}""",
    "mv_refresh_delta": f"""
        with {MERGED}, remaining as (select * from merged where cast(order_id as bigint) % 50 <> 0)
        {_mv('remaining')}""",
    "scd2_late_changes": f"""
        with {DIM_0},
        silver_1 as ({SILVER_1}), silver_2 as ({SILVER_2}),
        log as (
          select customer_id, customer_name, city, state, customer_segment, valid_from as effective, 0 as recorded from dim_0
          union all
          select customer_id, customer_name, city, state, customer_segment, _silver_updated_date, 1 from silver_1
          where _silver_updated_date = date '{model.FIRST_RUN}'
          union all
          select customer_id, customer_name, city, state, customer_segment, _silver_updated_date, 1 from silver_2
          union all
          select customer_id, customer_name || 'I', city, state, customer_segment, _silver_updated_date, 2 from silver_2
          where customer_name like '% II'
        ),
        told as (
          select * from log qualify row_number() over (partition by customer_id, effective order by recorded desc) = 1
        ),
        begins as (
          select * from told window w as (partition by customer_id order by effective)
          qualify lag(effective) over w is null
               or city is distinct from lag(city) over w or state is distinct from lag(state) over w
               or customer_name is distinct from lag(customer_name) over w
               or customer_segment is distinct from lag(customer_segment) over w
        )
        select customer_id || '_' || cast(effective as varchar) as _scd_key, customer_id, customer_name, city, state,
               customer_segment, effective as valid_from,
               coalesce(lead(effective) over w - 1, date '9999-12-31') as valid_to, lead(effective) over w is null as is_current
        from begins window w as (partition by customer_id order by effective)""",
    "reconcile_keys": f"""
        with {ORDERS},
        numbered as (select *, cast(order_id as bigint) as number from orders_all)
        select order_id, 'missing' as status, '' as differing_columns from numbered where number % 5003 = 1
        union all
        select 'x' || order_id, 'extra', '' from numbered where number % 7001 = 2
        union all
        select order_id, 'differing', case when number % 4999 <> 3 then 'order_amount'
                 when number % 9973 <> 7 and order_status = 'LOST' then 'order_amount' else 'order_amount,order_status' end
        from numbered where number % 5003 <> 1 and (number % 4999 = 3 or number % 9973 = 7)""",
    "extract_by_ledger": f"""
        with {MERGED}
        select o.* exclude (product_category)
        from orders_all o left join before b on b.order_id = o.order_id and cast(b.order_id as bigint) % 13 <> 0
        where b.order_id is null or o.customer_id is distinct from b.customer_id or o.product_id is distinct from b.product_id
           or o.order_amount is distinct from b.order_amount or o.order_status is distinct from b.order_status
           or o.order_date is distinct from b.order_date or o.region is distinct from b.region
           or o.updated_at is distinct from b.updated_at""",
    "incremental_run_twice": f"with {MERGED} select * from merged",
    "stream_dedup_events": f"""
        with {EVENTS}
        select *, cast(event_timestamp as date) as event_date,
               event_timestamp < timestamp '{LATE_BEFORE}' and cast(event_id as bigint) % 50 = 0 as is_late
        from events_all""",
    "stream_session_updates": """
        with flagged as (
          select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minute
                                   then 0 else 1 end as opens from events
        ),
        numbered as (select *, sum(opens) over (partition by user_id order by ts) as n from flagged)
        select user_id, cast(min(ts) as timestamp) as session_start, cast(max(ts) as timestamp) as session_end,
               count(*) as events
        from numbered group by user_id, n""",
    "dq_distribution_drift": f"""
        with {LINES},
        marks as (
          select list_distinct(list_transform(quantile_cont(cast(order_amount as double),
                   [{", ".join(str(i / 20) for i in range(1, 20))}]), lambda v: round(v, 2))) as cuts from lines
        ),
        counted as (
          select cast(date_trunc('month', _ingestion_date) as date) as run_date,
                 case when order_amount is null then -1
                      else len(list_filter(cuts, lambda c: c <= cast(order_amount as double))) end as bin, count(*) as k
          from lines, marks where _ingestion_date is not null group by all
        ),
        totals as (
          select run_date, cast(sum(k) as bigint) as n, lag(run_date) over (order by run_date) as before
          from counted group by run_date
        ),
        pairs as (
          select t.run_date, t.n, p.n as m, b.bin, coalesce(c.k, 0) as k, coalesce(d.k, 0) as j
          from totals t join totals p on p.run_date = t.before, (select unnest(range(-1, 20)) as bin) b
          left join counted c on c.run_date = t.run_date and c.bin = b.bin
          left join counted d on d.run_date = t.before and d.bin = b.bin
        ),
        shares as (
          select *, (k + 0.5e0) / (n + 10.5e0) as p, (j + 0.5e0) / (m + 10.5e0) as q,
                 abs(cast(sum(k) over w as double) / n - cast(sum(j) over w as double) / m) as gap
          from pairs window w as (partition by run_date order by bin)
        ),
        found as (
          select run_date, round(sum((p - q) * ln(p / q)), 6) as psi, round(max(gap), 6) as ks, any_value(m) as rows_before
          from shares group by run_date
        )
        select t.run_date, 'order_amount' as column_name, t.n as rows, f.rows_before, f.psi, f.ks,
               'order_amount_distribution_drift' as check_name, 'WARNING' as severity,
               case when f.psi is null or f.psi <= 0.25 then 'PASSED' else 'FAILED' end as status
        from totals t left join found f on f.run_date = t.run_date""",
    "create_orders_table": f"with {ORDERS} select {_OPTIMISED} from orders_all",
}
