"""Window, ranking, segment and serving-table queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.operators import daily as d
from oreline.operators import gold
from oreline.operators.incremental import extract_batch
from oreline.operators.merge import upsert_partitions
from oreline.operators.ranking import customer_segments, top_n_per_group as top_n
from oreline.operators.sessions import sessionize
from oreline.plans.load_queries import BY_YEAR, SILVER_SORT, stored_orders
from oreline.plans.views import DAILY, EVENTS, LOADED_UNTIL, MERGED, ORDERS, RUN_TS, SPEND
from oreline.scratch import fresh_path
from oreline.sources import model
from oreline.sources.publish import read_declared
from oreline.sources.schemas import ORDERS_SILVER


def top_n_per_group(spark: SparkSession, root: str) -> DataFrame:
    completed = model.orders(spark, root).filter(F.col("order_status") == "COMPLETED")
    facts = completed.select("order_id", "region", "order_amount", "order_date")
    return top_n(facts, "region", "order_amount", 3, "order_id", suffix="in_region")


def _daily(spark: SparkSession, root: str) -> DataFrame:
    return d.daily_revenue(model.orders(spark, root))


def running_totals(spark: SparkSession, root: str) -> DataFrame:
    totals = d.running_totals(_daily(spark, root))
    return totals.withColumns(
        {
            "cumulative_revenue": F.col("cumulative_revenue").cast("decimal(28,2)"),
            "mtd_revenue": F.col("mtd_revenue").cast("decimal(28,2)"),
            "rolling_7d_avg": F.round("rolling_7d_avg", 4),
        }
    )


def rolling_7day_range(spark: SparkSession, root: str) -> DataFrame:
    return d.rolling_days(_daily(spark, root), 7).withColumn("rolling_avg", F.round("rolling_avg", 4))


def ytd_revenue(spark: SparkSession, root: str) -> DataFrame:
    totals = d.ytd_revenue(_daily(spark, root))
    return totals.withColumn("ytd_revenue", F.col("ytd_revenue").cast("decimal(28,2)"))


def day_over_day(spark: SparkSession, root: str) -> DataFrame:
    changes = d.day_over_day(_daily(spark, root))
    return changes.withColumn("dod_change_pct", F.col("dod_change_pct").cast("double"))


def date_gaps(spark: SparkSession, root: str) -> DataFrame:
    return d.date_gaps(_daily(spark, root)).withColumn("missing_days", F.col("missing_days").cast("bigint"))


def sessionize_events(spark: SparkSession, root: str) -> DataFrame:
    events = model.events(spark, root).select("event_id", "user_id", "event_timestamp")
    return sessionize(events, "user_id", "event_timestamp").withColumn(
        "event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")
    )


def _segments(spark: SparkSession, root: str) -> DataFrame:
    return customer_segments(model.orders(spark, root))


def customer_deciles(spark: SparkSession, root: str) -> DataFrame:
    return _segments(spark, root).select("customer_id", "total_spend", "spend_decile")


def customer_percentiles(spark: SparkSession, root: str) -> DataFrame:
    return _segments(spark, root).select(
        "customer_id",
        "total_spend",
        F.round("median_spend", 4).alias("median_spend"),
        F.round("p90_spend", 4).alias("p90_spend"),
    )


def customer_tiers(spark: SparkSession, root: str) -> DataFrame:
    return _segments(spark, root).select("customer_id", "total_spend", "spend_decile", "customer_tier")


def mv_daily_revenue_by_region(spark: SparkSession, root: str) -> DataFrame:
    return gold.daily_revenue_by_region(model.orders(spark, root))


def mv_refresh_incremental(spark: SparkSession, root: str) -> DataFrame:
    """Build the aggregate before a load, load, refresh the dates orders came to or left."""
    path, silver = fresh_path(spark, "daily-revenue"), stored_orders(spark, root)
    gold.build_daily_revenue(read_declared(spark, silver, ORDERS_SILVER), path)
    changes = BY_YEAR.assign(extract_batch(model.orders_source(spark, root), LOADED_UNTIL, RUN_TS))
    load = upsert_partitions(
        spark, silver, BY_YEAR.partition_column, changes, ["order_id"], ORDERS_SILVER, SILVER_SORT, report=["order_date"]
    )
    # As many as there are calendar days.
    dates = [r[0] for r in load.moved["order_date"].distinct().collect()]
    gold.refresh_daily_revenue(spark, path, read_declared(spark, silver, ORDERS_SILVER), dates)
    return gold.read_daily_revenue(spark, path)


CLUSTER_CANDIDATES = ("region", "order_status", "product_category")


def cardinality_profile(spark: SparkSession, root: str) -> DataFrame:
    return gold.cardinality_profile(model.orders(spark, root), CLUSTER_CANDIDATES)


def clustering_advice(spark: SparkSession, root: str) -> DataFrame:
    columns = (*CLUSTER_CANDIDATES, "order_id", "customer_id", "product_id")
    return gold.clustering_advice(model.orders(spark, root), columns)


QUERIES = {
    "top_n_per_group": top_n_per_group,
    "daily_revenue": _daily,
    "running_totals": running_totals,
    "rolling_7day_range": rolling_7day_range,
    "ytd_revenue": ytd_revenue,
    "day_over_day": day_over_day,
    "date_gaps": date_gaps,
    "sessionize_events": sessionize_events,
    "customer_deciles": customer_deciles,
    "customer_percentiles": customer_percentiles,
    "customer_tiers": customer_tiers,
    "mv_daily_revenue_by_region": mv_daily_revenue_by_region,
    "mv_refresh_incremental": mv_refresh_incremental,
    "cardinality_profile": cardinality_profile,
    "clustering_advice": clustering_advice,
}


# The average with six decimals, rounded half up in whole numbers: a division of decimals is a
# division of doubles in DuckDB.
_HALF_MILLIONTHS = "cast(sum(order_amount) * 100 as hugeint) * 20000"
_EXACT_AVG = (
    f"cast(cast(({_HALF_MILLIONTHS} + count(order_amount)) // (2 * count(order_amount)) as decimal(22,0)) "
    "* cast(0.000001 as decimal(7,6)) as decimal(22,6))"
)


def _mv(table: str) -> str:
    return f"""
        select order_date, region, order_status, count(order_id) as total_orders,
               cast(sum(order_amount) as decimal(28,2)) as total_revenue,
               {_EXACT_AVG} as avg_order_value
        from {table} where order_status = 'COMPLETED' group by order_date, region, order_status"""


_REVENUE = "cast(daily_revenue as decimal(28,2)) as daily_revenue"
_TIER_ORDER = "order by total_spend desc, customer_id"
_SPEND = "customer_id, cast(total_spend as decimal(28,2)) as total_spend"

ORACLE = {
    "top_n_per_group": f"""
        with {ORDERS}
        select order_id, region, order_amount, order_date,
               cast(rank() over (partition by region order by order_amount desc) as integer) as rank_in_region,
               cast(dense_rank() over (partition by region order by order_amount desc) as integer)
                 as dense_rank_in_region,
               cast(row_number() over (partition by region order by order_amount desc, order_id) as integer)
                 as row_num_in_region
        from orders_all where order_status = 'COMPLETED' qualify rank_in_region <= 3""",
    "daily_revenue": f"with {DAILY} select order_date, region, {_REVENUE} from daily",
    "running_totals": f"""
        with {DAILY}
        select order_date, region, {_REVENUE},
               cast(sum(daily_revenue) over (partition by region order by order_date
                 rows between unbounded preceding and current row) as decimal(28,2)) as cumulative_revenue,
               round(avg(cast(daily_revenue as double)) over (partition by region order by order_date
                 rows between 6 preceding and current row), 4) as rolling_7d_avg,
               cast(sum(daily_revenue) over (partition by region, date_trunc('month', order_date) order by order_date
                 rows between unbounded preceding and current row) as decimal(28,2)) as mtd_revenue
        from daily""",
    "rolling_7day_range": f"""
        with {DAILY}
        select order_date, region, {_REVENUE},
               round(avg(cast(daily_revenue as double)) over (partition by region order by order_date
                 range between interval 6 day preceding and current row), 4) as rolling_avg
        from daily""",
    "ytd_revenue": f"""
        with {DAILY}
        select order_date, region, {_REVENUE},
               cast(sum(daily_revenue) over (partition by region, year(order_date) order by order_date
                 rows between unbounded preceding and current row) as decimal(28,2)) as ytd_revenue
        from daily""",
    "day_over_day": f"""
        with {DAILY},
        pairs as (
          select *, lag(daily_revenue) over (partition by region order by order_date) as previous,
                 lead(daily_revenue) over (partition by region order by order_date) as following
          from daily
        )
        select order_date, region, {_REVENUE},
               cast(coalesce(previous, 0) as decimal(28,2)) as prev_day_revenue,
               round(cast((daily_revenue - previous) as double) / nullif(cast(previous as double), 0) * 100, 2)
                 as dod_change_pct,
               cast(following as decimal(28,2)) as next_day_revenue
        from pairs""",
    "date_gaps": f"""
        with {DAILY},
        pairs as (select region, order_date, lag(order_date) over (partition by region order by order_date)
                    as previous_date from daily)
        select region, order_date, previous_date, cast(order_date - previous_date - 1 as bigint) as missing_days
        from pairs where order_date - previous_date > 1""",
    "sessionize_events": f"""
        with {EVENTS},
        flagged as (
          select event_id, user_id, event_timestamp,
                 case when event_timestamp - lag(event_timestamp) over (partition by user_id order by event_timestamp)
                           <= interval 30 minute then 0 else 1 end as opens
          from events_all
        )
        select event_id, user_id, event_timestamp,
               cast(sum(opens) over (partition by user_id order by event_timestamp) as bigint) as session_no
        from flagged""",
    "customer_deciles": f"""
        with {SPEND} select {_SPEND}, cast(ntile(10) over ({_TIER_ORDER}) as integer) as spend_decile from spend""",
    "customer_percentiles": f"""
        with {SPEND}
        select {_SPEND},
               round(quantile_cont(cast(total_spend as double), 0.5) over (), 4) as median_spend,
               round(quantile_cont(cast(total_spend as double), 0.9) over (), 4) as p90_spend
        from spend""",
    "customer_tiers": f"""
        with {SPEND},
        tiled as (select *, ntile(10) over ({_TIER_ORDER}) as tile from spend)
        select {_SPEND}, cast(tile as integer) as spend_decile,
               case when tile = 1 then 'PLATINUM' when tile <= 3 then 'GOLD' when tile <= 6 then 'SILVER'
                    else 'BRONZE' end as customer_tier
        from tiled""",
    "mv_daily_revenue_by_region": f"with {ORDERS} {_mv('orders_all')}",
    "mv_refresh_incremental": f"with {MERGED} {_mv('merged')}",
    "cardinality_profile": f"""
        with {ORDERS}
        select 'region' as column_name, count(distinct region) as distinct_values from orders_all
        union all select 'order_status', count(distinct order_status) from orders_all
        union all select 'product_category', count(distinct product_category) from orders_all""",
    "clustering_advice": f"""
        with {ORDERS},
        counts as (
          select 'region' as column_name, count(distinct region) as distinct_values, count(*) as n from orders_all
          union all select 'order_status', count(distinct order_status), count(*) from orders_all
          union all select 'product_category', count(distinct product_category), count(*) from orders_all
          union all select 'order_id', count(distinct order_id), count(*) from orders_all
          union all select 'customer_id', count(distinct customer_id), count(*) from orders_all
          union all select 'product_id', count(distinct product_id), count(*) from orders_all
        )
        select column_name, distinct_values, round(cast(distinct_values as double) / n, 6) as distinct_ratio
        from counts where cast(distinct_values as double) / n <= 0.5
        order by distinct_values, column_name limit 4""",
}
