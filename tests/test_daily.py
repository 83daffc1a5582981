import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from oreline.operators import daily
from oreline.plans.explain import explained
from oreline.sources import model

D = dt.date


def make(spark, rows):
    return spark.createDataFrame(
        [(D(2024, m, d), "N", None if v is None else Decimal(v)) for m, d, v in rows],
        "order_date date, region string, daily_revenue decimal(28,2)",
    )


def by_date(df):
    return {r.order_date: r for r in df.collect()}


def test_day_over_day_edges(spark):
    got = by_date(daily.day_over_day(make(spark, [(1, 1, 0), (1, 2, 50), (1, 5, 75)])))
    first, second, third = (got[D(2024, 1, d)] for d in (1, 2, 5))
    assert first.prev_day_revenue == 0 and first.dod_change_pct is None and first.next_day_revenue == 50
    assert second.dod_change_pct is None  # previous is zero
    assert float(third.dod_change_pct) == 50.0 and third.prev_day_revenue == 50  # previous row, not day
    assert third.next_day_revenue is None


def test_gap_lists_the_missing_days(spark):
    rows = daily.date_gaps(make(spark, [(1, 1, 1), (1, 2, 1), (1, 5, 1)])).collect()
    assert [(r.previous_date, r.order_date, r.missing_days) for r in rows] == [(D(2024, 1, 2), D(2024, 1, 5), 2)]


def test_rows_and_days_differ_when_dates_are_missing(spark):
    df = make(spark, [(1, 1, 10), (1, 20, 30)])
    by_rows = by_date(daily.running_totals(df))[D(2024, 1, 20)]
    by_days = by_date(daily.rolling_days(df, 7))[D(2024, 1, 20)]
    assert by_rows.rolling_7d_avg == 20.0 and by_days.rolling_avg == 30.0


def test_totals_restart_with_month_and_year(spark):
    df = spark.createDataFrame(
        [(D(2023, 12, 31), "N", Decimal(5)), (D(2024, 1, 1), "N", Decimal(7)), (D(2024, 2, 1), "N", Decimal(9))],
        "order_date date, region string, daily_revenue decimal(28,2)",
    )
    totals = by_date(daily.running_totals(df))
    assert [totals[d].mtd_revenue for d in sorted(totals)] == [5, 7, 9]
    assert [totals[d].cumulative_revenue for d in sorted(totals)] == [5, 12, 21]
    years = by_date(daily.ytd_revenue(df))
    assert [years[d].ytd_revenue for d in sorted(years)] == [5, 7, 16]


def test_last_running_total_is_the_sum(spark):
    df = daily.daily_revenue(model.orders(spark, "/root/testdata/sf0.001"))
    totals = daily.running_totals(df).groupBy("region").agg(
        F.max_by("cumulative_revenue", "order_date").alias("last"), F.sum("daily_revenue").alias("all")
    )
    assert totals.filter("last != all").isEmpty() and totals.count() == 5


def test_three_windows_share_one_shuffle(spark):
    df = make(spark, [(1, 1, 1)])
    assert explained(daily.running_totals(df), "simple").count("Exchange ") == 1
