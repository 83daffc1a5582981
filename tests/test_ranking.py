import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from oreline.operators.positions import in_order
from oreline.operators.ranking import (
    _best_values,
    customer_segments,
    distributed_ntile,
    exact_percentiles,
    percentiles_of,
    tile,
    top_n_per_group,
    total_spend,
)
from oreline.plans.explain import explained
from oreline.scratch import fresh_path
from oreline.sources import model

SMALL = "/root/testdata/sf0.001"


def ranks(spark, rows, n=3):
    df = spark.createDataFrame(rows, "id string, region string, amount int")
    df = df.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    found = top_n_per_group(df, "region", "amount", n, "id").collect()
    return {r.id: (r.rank_in_group, r.dense_rank_in_group, r.row_num_in_group) for r in found}


def test_tied_amounts(spark):
    got = ranks(spark, [("a", "N", 100), ("b", "N", 100), ("c", "N", 80)])
    assert got == {"a": (1, 1, 1), "b": (1, 1, 2), "c": (3, 2, 3)}


def test_all_ties_at_the_last_rank_are_kept(spark):
    rows = [(f"{i:04d}", "N", 50) for i in range(500)] + [("top", "N", 90), ("low", "N", 10)]
    got = ranks(spark, rows, n=2)
    assert len(got) == 501 and "low" not in got
    assert got["top"] == (1, 1, 1) and got["0499"] == (2, 2, 501)


def test_groups_are_limited_before_the_shuffle(spark):
    """Both sides of the one shuffle keep at most n rows per group, in a scan without other columns."""
    path = fresh_path(spark, "ranked")
    model.orders(spark, SMALL).write.parquet(path)
    plan = explained(_best_values(spark.read.parquet(path), "region", "order_amount", 3), "simple")
    above, below = plan.split("Exchange ")  # one shuffle
    assert "row_number(), 3, Final" in above and "row_number(), 3, Partial" in below
    assert "order_status" not in plan


def test_missing_amounts_rank_last_and_groups_are_separate(spark):
    got = ranks(spark, [("a", "N", None), ("b", "N", 5), ("c", None, 7), ("d", None, None)], n=2)
    assert got == {"b": (1, 1, 1), "a": (2, 2, 2), "c": (1, 1, 1), "d": (2, 2, 2)}


def test_positions_over_many_ranges(spark):
    df = spark.range(10_000).select(F.col("id"), (F.col("id") % 3).alias("hot"))
    ordered = in_order(df, F.desc("hot"), "id", partitions=7)
    assert ordered.total == 10_000 and len(ordered.starts) > 1
    window = Window.orderBy(F.desc("hot"), "id")
    expected = df.withColumn("position", F.row_number().over(window) - 1)
    assert ordered.numbered().select("id", "hot", "position").exceptAll(
        expected.select("id", "hot", F.col("position").cast("bigint"))
    ).isEmpty()
    picked = {r.id for r in ordered.at({0, 5000, 9999}).collect()}
    assert picked == {r.id for r in expected.filter(F.col("position").isin(0, 5000, 9999)).collect()}


@pytest.mark.parametrize("rows,k", [(12, 10), (3, 10), (100, 10), (101, 10), (7, 1)])
def test_tiles_equal_the_builtin(spark, rows, k):
    df = spark.range(rows)
    expected = df.withColumn("tile", F.ntile(k).over(Window.orderBy("id")))
    got = df.withColumn("tile", tile(F.col("id"), rows, k))
    assert got.exceptAll(expected).isEmpty()


def test_distributed_ntile_has_no_single_task_window(spark):
    orders = model.orders(spark, SMALL)
    tiles = distributed_ntile(total_spend(orders), [F.desc("total_spend"), "customer_id"], 10)
    assert "SinglePartition" not in explained(tiles)
    expected = total_spend(orders).withColumn(
        "tile", F.ntile(10).over(Window.orderBy(F.desc("total_spend"), "customer_id"))
    )
    assert tiles.select("customer_id", "total_spend", "tile").exceptAll(expected).isEmpty()


@pytest.mark.parametrize("size", [1, 2, 5, 100, 997])
def test_percentiles_interpolate(spark, size):
    values = [float((i * 37) % 101) for i in range(size)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, None])], "id int, v double")
    ordered = in_order(df, F.desc_nulls_last("v"), "id", partitions=4)
    got = percentiles_of(ordered, "v", (0.0, 0.5, 0.9, 1.0))
    for q, value in zip((0.0, 0.5, 0.9, 1.0), got):
        assert math.isclose(value, float(np.quantile(values, q)), abs_tol=1e-9)


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "id int, v double")
    assert exact_percentiles(empty, "v", (0.5,)) == [None]


def test_equal_rows_are_cut_into_ranges(spark):
    copies = spark.range(20_000).select(F.lit(1.0).alias("v"))
    ordered = in_order(copies, "v", partitions=8)
    sizes = [b[1] - a[1] for a, b in zip(ordered.starts, ordered.starts[1:])]
    assert len(ordered.starts) > 4 and max(sizes) < 10_000
    numbered = ordered.numbered()
    assert numbered.select("position").distinct().count() == 20_000
    assert numbered.agg(F.max("position")).first()[0] == 19_999
    assert exact_percentiles(copies, "v", (0.5,)) == [1.0]


def test_tiers_follow_deciles(spark):
    rows = customer_segments(model.orders(spark, SMALL)).collect()
    tiers = {1: "PLATINUM", 2: "GOLD", 3: "GOLD", 4: "SILVER", 5: "SILVER", 6: "SILVER"}
    assert rows and all(r.customer_tier == tiers.get(r.spend_decile, "BRONZE") for r in rows)


def test_approximate_percentiles_are_close(spark):
    from oreline.operators.ranking import approximate_percentiles

    df = spark.range(10_001).selectExpr("cast(id as double) as v")
    low, high = approximate_percentiles(df, "v", (0.5, 0.9))
    assert abs(low - 5000) <= 2 and abs(high - 9000) <= 2
    assert approximate_percentiles(df.limit(0), "v", (0.5,)) == [None]
