"""Serving aggregates and table statistics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.functions.scalars import day
from oreline.scratch import written
from oreline.sources.files import exists
from oreline.sources.layout import ByDate, write_partitioned
from oreline.sources.publish import in_partitions, partition_values, publish_partitions, read_declared
from oreline.sources.schemas import DAILY_REVENUE

# A day of the aggregate is a handful of rows, so one partition holds a year.
DAILY_REVENUE_LAYOUT = ByDate("order_date", unit="year")


def filtered_revenue(orders: DataFrame, region: str, status: str) -> DataFrame:
    """Revenue of one region and status; both filters reach the scan."""
    picked = orders.filter((F.col("region") == region) & (F.col("order_status") == status))
    return picked.agg(F.sum("order_amount").alias("revenue"), F.count("*").alias("orders"))


def daily_revenue_by_region(orders: DataFrame) -> DataFrame:
    """Completed orders, revenue and average order value per day, region and status."""
    completed = orders.filter(F.col("order_status") == "COMPLETED")
    return completed.groupBy("order_date", "region", "order_status").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("order_amount").alias("total_revenue"),
        F.avg("order_amount").alias("avg_order_value"),
    )


def build_daily_revenue(orders: DataFrame, path: str) -> None:
    write_partitioned(daily_revenue_by_region(orders), path, DAILY_REVENUE_LAYOUT)


def refresh_daily_revenue(spark: SparkSession, path: str, orders: DataFrame, dates: Iterable) -> list:
    """Recompute the given order dates of the stored aggregate and leave the others.

    Reads the orders of those dates only (only their partitions, if ``orders`` is partitioned
    like the aggregate), and rewrites the partitions of the aggregate they fall in. Equal to a
    full rebuild if ``dates`` has every date an order was added to, changed on or moved from,
    which a stored upsert reports; None stands for orders without a date.
    """
    dates = sorted({None if d is None else str(d) for d in dates}, key=str)
    if not dates:
        return []
    if not exists(spark, path):
        raise FileNotFoundError(path)
    column = DAILY_REVENUE_LAYOUT.partition_column
    changed = spark.createDataFrame([(d,) for d in dates], "changed string").select(F.col("changed").cast("date"))
    touched = partition_values(DAILY_REVENUE_LAYOUT.assign(changed.withColumnRenamed("changed", "order_date")), column)
    this_date = F.col("order_date").eqNullSafe(F.col("changed"))

    # One row per changed calendar date, so the broadcast is bounded by the calendar.
    if column in orders.columns:
        base = in_partitions(orders, column, touched)
    else:
        known = [d for d in dates if d is not None]
        wanted = F.col("order_date").between(day(known[0]), day(known[-1])) if known else F.lit(False)
        base = orders.filter(wanted | F.col("order_date").isNull() if None in dates else wanted)
    fresh = daily_revenue_by_region(base.join(F.broadcast(changed), this_date, "left_semi"))
    stored = in_partitions(read_declared(spark, path, DAILY_REVENUE), column, touched)
    kept = stored.join(F.broadcast(changed), this_date, "left_anti")
    content = kept.unionByName(DAILY_REVENUE_LAYOUT.assign(fresh))
    return publish_partitions(written(content, "refresh"), path, column, touched, schema=DAILY_REVENUE)


def read_daily_revenue(spark: SparkSession, path: str) -> DataFrame:
    stored = read_declared(spark, path, DAILY_REVENUE)
    return stored.drop(DAILY_REVENUE_LAYOUT.partition_column)


def cardinality_profile(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column, from one scan.

    Exact counts make values unique in the map tasks before the shuffle; ``approximate`` sends one
    small sketch per task and column, with a relative error of about five percent.
    """
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    counts = df.agg(*[distinct(c).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_values")) for c in columns]
    return counts.select(F.inline(F.array(*pairs)))


def clustering_advice(
    df: DataFrame, columns: Sequence[str], max_cols: int = 4, max_ratio: float = 0.5
) -> DataFrame:
    """Which columns to sort files by, coarsest first; nearly unique columns are left out.

    A first pass with sketches finds the columns that are far beyond ``max_ratio``; only the
    others are counted exactly, so the values of unique ids are never shuffled.
    """
    sketched = df.agg(F.count("*").alias("_rows"), *[F.approx_count_distinct(c, 0.02).alias(c) for c in columns]).first()
    # Ten standard errors, so that no column that belongs to the answer is left out.
    columns = [c for c in columns if sketched[c] <= 1.2 * max_ratio * sketched["_rows"]]
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, distinct_values bigint, distinct_ratio double")
    counts = df.agg(F.count("*").alias("_rows"), *[F.countDistinct(c).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_values")) for c in columns]
    ratio = F.try_divide(F.col("distinct_values").cast("double"), F.col("_rows").cast("double"))
    return (
        counts.select("_rows", F.inline(F.array(*pairs)))
        .withColumn("distinct_ratio", F.round(ratio, 6))
        .filter(ratio <= max_ratio)
        .orderBy("distinct_values", "column_name")
        .limit(max_cols)
        .select("column_name", "distinct_values", "distinct_ratio")
    )
