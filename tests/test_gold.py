import datetime as dt

from pyspark.sql import functions as F

from oreline.operators import gold
from oreline.plans.explain import explained
from oreline.scratch import fresh_path
from oreline.sources import model

SMALL = "/root/testdata/sf0.001"


def same(a, b):
    columns = b.columns
    return a.select(columns).exceptAll(b).isEmpty() and b.exceptAll(a.select(columns)).isEmpty()


def test_refresh_equals_rebuild(spark):
    path, orders = fresh_path(spark, "mv"), model.orders(spark, SMALL)
    gold.build_daily_revenue(orders, path)
    assert same(gold.read_daily_revenue(spark, path), gold.daily_revenue_by_region(orders))
    # One month loses all its orders, one day moves, one day is repriced.
    moved = F.col("order_date") == "1997-03-03"
    changed = orders.filter("trunc(order_date, 'MONTH') != date'1996-05-01'").withColumns(
        {
            "order_date": F.when(moved, F.lit("2005-01-01").cast("date")).otherwise(F.col("order_date")),
            "order_amount": F.when(F.col("order_date") == "1998-06-06", F.lit(1).cast("decimal(18,2)")).otherwise(
                F.col("order_amount")
            ),
        }
    )
    may = [dt.date(1996, 5, d) for d in range(1, 32)]
    dates = [*may, dt.date(1997, 3, 3), dt.date(2005, 1, 1), dt.date(1998, 6, 6)]
    gold.refresh_daily_revenue(spark, path, changed, dates)
    assert same(gold.read_daily_revenue(spark, path), gold.daily_revenue_by_region(changed))
    assert gold.refresh_daily_revenue(spark, path, changed, []) == []
    # A day loses its date.
    lost = changed.withColumn("order_date", F.when(F.col("order_date") != "1995-02-02", F.col("order_date")))
    gold.refresh_daily_revenue(spark, path, lost, [dt.date(1995, 2, 2), None])
    assert same(gold.read_daily_revenue(spark, path), gold.daily_revenue_by_region(lost))


def test_profile_reads_the_table_once(spark):
    path = fresh_path(spark, "profile")
    model.orders(spark, SMALL).write.parquet(path)
    profile = gold.cardinality_profile(spark.read.parquet(path), ["region", "order_status"])
    assert explained(profile, "simple").count("FileScan") == 1
    assert {r.column_name: r.distinct_values for r in profile.collect()} == {"region": 5, "order_status": 3}


def test_advice_leaves_out_unique_columns_and_stops_at_four(spark):
    df = spark.range(1000).select(
        F.col("id"), *[(F.col("id") % n).alias(f"c{n}") for n in (2, 3, 5, 7, 11)], F.lit(None).cast("int").alias("empty")
    )
    advice = gold.clustering_advice(df, ["id", "c11", "c7", "c5", "c3", "c2"])
    assert [r.column_name for r in advice.collect()] == ["c2", "c3", "c5", "c7"]
    assert gold.clustering_advice(df.limit(0), ["id"]).isEmpty()
    assert gold.cardinality_profile(df, ["empty"]).first().distinct_values == 0


def test_approximate_counts_are_close(spark):
    df = spark.range(50_000).selectExpr("id", "id % 777 as c")
    found = {r.column_name: r.distinct_values for r in gold.cardinality_profile(df, ["id", "c"], approximate=True).collect()}
    assert abs(found["id"] - 50_000) < 10_000 and abs(found["c"] - 777) < 160
