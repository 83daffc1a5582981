"""Analytics over daily revenue.

Orders are summed per day and region first, with partial sums in the map tasks. What the
windows below sort is one row per calendar day and region, however many orders there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from oreline.functions.scalars import percent_change

_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def _by_day() -> WindowSpec:
    return Window.partitionBy("region").orderBy("order_date")


def daily_revenue(orders: DataFrame) -> DataFrame:
    completed = orders.filter(F.col("order_status") == "COMPLETED")
    return completed.groupBy("order_date", "region").agg(F.sum("order_amount").alias("daily_revenue"))


def _to_date(unit: str):
    """Sum from the start of the month or year; the period start is a second window key."""
    window = Window.partitionBy("region", F.trunc("order_date", unit)).orderBy("order_date")
    return F.sum("daily_revenue").over(window.rowsBetween(*_SO_FAR))


def running_totals(daily: DataFrame) -> DataFrame:
    """All-time cumulative sum, average of the last 7 rows, month-to-date sum.

    Partitioning on region once serves all three windows.
    """
    return daily.repartition("region").withColumns(
        {
            "cumulative_revenue": F.sum("daily_revenue").over(_by_day().rowsBetween(*_SO_FAR)),
            "rolling_7d_avg": F.avg(F.col("daily_revenue").cast("double")).over(_by_day().rowsBetween(-6, 0)),
            "mtd_revenue": _to_date("MONTH"),
        }
    )


def rolling_days(daily: DataFrame, days: int = 7) -> DataFrame:
    """Average over the last ``days`` calendar days, counting only days that have rows."""
    window = Window.partitionBy("region").orderBy(F.unix_date("order_date")).rangeBetween(1 - days, 0)
    return daily.withColumn("rolling_avg", F.avg(F.col("daily_revenue").cast("double")).over(window))


def ytd_revenue(daily: DataFrame) -> DataFrame:
    return daily.withColumn("ytd_revenue", _to_date("YEAR"))


def day_over_day(daily: DataFrame) -> DataFrame:
    """Previous and next row per region and the change in percent.

    The previous row is the previous day that has revenue; ``date_gaps`` shows missing days.
    """
    revenue = F.col("daily_revenue")
    previous = F.lag("daily_revenue").over(_by_day())
    return daily.withColumns(
        {
            "prev_day_revenue": F.lag("daily_revenue", 1, 0).over(_by_day()),
            "dod_change_pct": F.round(percent_change(revenue, previous), 2),
            "next_day_revenue": F.lead("daily_revenue").over(_by_day()),
        }
    )


def date_gaps(daily: DataFrame) -> DataFrame:
    """Runs of missing days: the last day before, the first day after, days missing."""
    previous = F.lag("order_date").over(_by_day())
    return (
        daily.select("region", "order_date", previous.alias("previous_date"))
        .withColumn("missing_days", F.datediff("order_date", "previous_date") - 1)
        .filter(F.col("missing_days") > 0)
    )
