"""The daily revenue aggregate kept current by signed changes, without reading the orders again.

Counts and sums take back an old version of an order and add the new one, so a refresh costs what changed: the
changed rows, and the partitions of the aggregate they fall in. Averages follow from sums and counts. A group
goes with its last order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.operators.gold import DAILY_REVENUE_LAYOUT
from oreline.operators.merge import SIGN
from oreline.scratch import written
from oreline.sources.layout import write_partitioned
from oreline.sources.publish import in_partitions, partition_values, publish_partitions, read_declared
from oreline.sources.schemas import DAILY_REVENUE_STATE, conform

GROUP = ("order_date", "region", "order_status")
SUMS = ("total_orders", "total_revenue", "priced_orders", "order_rows")
#: What an image of an order must have.
IMAGE = ("order_id", "order_date", "region", "order_status", "order_amount")


def revenue_state(images: DataFrame, sign: Column | None = None) -> DataFrame:
    """Counts and sums of completed orders per day, region and status; ``sign`` weighs each row (default 1)."""
    sign = F.lit(1) if sign is None else sign
    amount = F.col("order_amount") * sign.cast("decimal(1,0)")
    return (
        images.filter(F.col("order_status") == "COMPLETED")
        .groupBy(*GROUP)
        .agg(
            F.sum(F.when(F.col("order_id").isNotNull(), sign).otherwise(0)).cast("bigint").alias("total_orders"),
            F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(28,2)").alias("total_revenue"),
            F.sum(F.when(F.col("order_amount").isNotNull(), sign).otherwise(0)).cast("bigint").alias("priced_orders"),
            F.sum(sign).cast("bigint").alias("order_rows"),
        )
    )


def build_revenue_state(orders: DataFrame, path: str, load_id: str) -> None:
    """The aggregate of all orders, as of the load ``load_id``."""
    state = DAILY_REVENUE_LAYOUT.assign(revenue_state(orders).withColumn("applied", F.lit(load_id)))
    write_partitioned(conform(state, DAILY_REVENUE_STATE).drop(DAILY_REVENUE_LAYOUT.partition_column), path, DAILY_REVENUE_LAYOUT)


def apply_revenue_changes(spark: SparkSession, path: str, images: DataFrame, load_id: str) -> list:
    """Fold the signed ``images`` of one load into the stored aggregate; returns the partitions rewritten.

    Every partition carries the last load folded into it, so a load that is applied again, after a stop or by
    mistake, changes only the partitions it had not reached. A partition whose last group goes keeps one row
    without a group that says so. Changes that take back more than a group holds are an error: they are not
    changes of this aggregate.
    """
    column = DAILY_REVENUE_LAYOUT.partition_column
    delta = revenue_state(images, F.col(SIGN))
    moving = F.lit(False)
    for c in SUMS:
        moving = moving | (F.col(c) != 0)
    delta = written(DAILY_REVENUE_LAYOUT.assign(delta.filter(moving)), "revenue-delta")
    reached = partition_values(delta, column)
    if not reached:
        return []
    stored = in_partitions(read_declared(spark, path, DAILY_REVENUE_STATE), column, reached)
    done = {r[0] for r in stored.filter(F.col("applied") == load_id).select(column).distinct().collect()}
    touched = [p for p in reached if p not in done]
    if not touched:
        return []
    old = in_partitions(stored, column, touched).filter("order_rows > 0").select(column, *GROUP, *SUMS)
    new = in_partitions(delta, column, touched).select(column, *GROUP, *SUMS)
    folded = old.unionByName(new).groupBy(column, *GROUP).agg(*[F.sum(c).alias(c) for c in SUMS])
    below = F.raise_error(F.lit("the changes take back more than the aggregate holds")).cast("boolean")
    groups = folded.filter(F.when(F.least("order_rows", "total_orders", "priced_orders") < 0, below).otherwise(F.col("order_rows") > 0))
    nothing = [F.lit(None).alias(c) for c in GROUP] + [F.lit(0).alias(c) for c in SUMS]
    emptied = new.select(column).distinct().join(groups.select(column).distinct().withColumnRenamed(column, "_left"), F.col(column).eqNullSafe(F.col("_left")), "left_anti")
    content = conform(groups.withColumn("applied", F.lit(load_id)), DAILY_REVENUE_STATE).unionByName(
        conform(emptied.select(column, *nothing, F.lit(load_id).alias("applied")), DAILY_REVENUE_STATE)
    )
    publish_partitions(written(content, "revenue-state"), path, column, touched, schema=DAILY_REVENUE_STATE)
    return sorted(touched, key=str)


def read_revenue_state(spark: SparkSession, path: str) -> DataFrame:
    """The aggregate as it is served: the columns and types of a rebuild."""
    state = read_declared(spark, path, DAILY_REVENUE_STATE).filter("order_rows > 0")
    priced = F.col("priced_orders") > 0
    average = F.when(priced, F.col("total_revenue") / F.col("priced_orders")).cast("decimal(22,6)")
    revenue = F.when(priced, F.col("total_revenue")).alias("total_revenue")
    return state.select(*GROUP, "total_orders", revenue, average.alias("avg_order_value"))
