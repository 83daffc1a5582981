"""One key holds a third of all rows, joins are shuffled, and partitions count as skewed early."""

import pytest
from pyspark.sql import functions as F

from oreline.operators import merge
from oreline.operators.merge import mark_deleted, merge_upsert, unique_batch
from oreline.operators.scd2 import scd2_asof_join
from oreline.operators.sessions import sessionize
from oreline.plans.explain import explained
from oreline.scratch import written

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "20",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}
ROWS, HOT = 300_000, 7


@pytest.fixture(scope="module")
def skewed(spark):
    saved = {k: spark.conf.get(k) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in saved.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def table(skewed):
    number = F.col("id")
    rows = skewed.range(0, ROWS, 1, 16).select(
        F.when(number % 3 == 0, HOT).otherwise(number).alias("k"),
        F.sha2(number.cast("string"), 256).alias("note"),
        F.lit(1).alias("v"),
        F.timestamp_seconds(number).alias("updated_at"),
    )
    return written(rows, "skewed")


@pytest.fixture(scope="module")
def batch(skewed):
    rows = skewed.range(0, 50_000).selectExpr("id as k", "2 as v", "timestamp_seconds(id) as updated_at")
    return unique_batch(rows, ["k"])


def run(df) -> str:
    """The plan as adaptive execution finally ran it."""
    df.collect()
    return explained(df, "simple").split("== Initial Plan ==")[0]


def test_merge_splits_the_hot_key(skewed, table, batch):
    merged = merge_upsert(table, batch, ["k"])
    assert "SortMergeJoin(skew=true)" in run(merged)
    old, new = merged.filter("note is not null"), merged.filter("note is null")
    assert old.count() == ROWS
    assert old.filter("(k < 50000) != (v = 2)").isEmpty()
    expected_new = batch.table.join(table.select("k"), "k", "left_anti").select("k")
    assert sorted(r.k for r in new.select("k").collect()) == sorted(r.k for r in expected_new.collect())


def test_target_keys_are_made_unique_first_and_nothing_is_broadcast(skewed, table, batch):
    plan = explained(merge.keys_held(table, batch.table, ["k"]), "simple")
    assert "Broadcast" not in plan  # the session forbids it
    below = plan.split("LeftSemi")[1]
    assert "HashAggregate(keys=[k" in below  # under the join, on the target's side


def test_repeated_keys_are_reduced_before_the_shuffle(skewed, table):
    latest = unique_batch(table, ["k"], on_duplicate="latest")
    assert latest.rows == table.select("k").distinct().count()
    hot = latest.table.filter(F.col("k") == HOT).first()
    assert hot.updated_at == table.filter(F.col("k") == HOT).agg(F.max("updated_at")).first()[0]


def test_soft_delete_and_lookup_split_the_hot_key(skewed, table):
    snapshot = table.filter("k < 100000")
    marked = mark_deleted(table, snapshot, ["k"])
    assert "SortMergeJoin(skew=true)" in run(marked)
    assert marked.filter("is_deleted = (k < 100000)").isEmpty()
    dim = skewed.range(0, ROWS).selectExpr(
        "id as k", "date'2020-01-01' as valid_from", "date'9999-12-31' as valid_to", "sha2(string(id), 256) as city"
    )
    facts = table.withColumn("day", F.lit("2021-01-01").cast("date"))
    joined = scd2_asof_join(facts, written(dim, "dim"), "k", "day", ["city"])
    assert "SortMergeJoin(skew=true)" in run(joined)
    assert joined.count() == ROWS and joined.filter("city != sha2(string(k), 256)").isEmpty()


def test_events_at_one_time_are_split(skewed, table):
    """A third of the events belong to one user and one instant."""
    events = table.select(
        F.col("k").alias("user"),
        F.when(F.col("k") == HOT, F.lit("2024-01-01").cast("timestamp")).otherwise(F.col("updated_at")).alias("ts"),
        "note",
    )
    numbered = sessionize(events, "user", "ts")
    assert "SortMergeJoin(skew=true)" in run(numbered)
    assert numbered.count() == ROWS
    assert numbered.filter(F.col("user") == HOT).agg(F.max("session_no"), F.count("*")).first() == (1, ROWS // 3 + 1)
