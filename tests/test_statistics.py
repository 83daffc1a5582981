"""Stored statistics: merged answers against the table itself."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from oreline.plans.explain import explained
from oreline.scratch import fresh_path
from oreline.sources import statistics as st
from tests.ddl import schema as ddl

SCHEMA = ddl("id bigint, amount decimal(10,2), city string, at timestamp, day date")
COLUMNS = ("id", "amount", "city", "at")


def rows(spark, n, day, shift=0):
    """A day's rows: unique ids, 200 cities, some missing values."""
    return spark.range(shift, shift + n).select(
        "id",
        F.when(F.col("id") % 10 != 0, (F.col("id") % 1000) / 4).cast("decimal(10,2)").alias("amount"),
        F.concat(F.lit("city"), (F.col("id") % 200).cast("string")).alias("city"),
        F.timestamp_seconds(F.col("id")).alias("at"),
        F.lit(day).cast("date").alias("day"),
    )


@pytest.fixture
def table(spark):
    path, stats = fresh_path(spark, "table"), fresh_path(spark, "stats")
    for i, day in enumerate(("2024-01-01", "2024-01-02", None)):
        rows(spark, 20_000, day, 15_000 * i).write.mode("append").partitionBy("day").parquet(path)
    st.refresh_statistics(spark, stats, path, SCHEMA, "day", COLUMNS)
    return path, stats


def test_merged_statistics(spark, table):
    path, stats = table
    got = {r.column_name: r for r in st.table_statistics(st.read_statistics(spark, stats)).collect()}
    whole = spark.read.schema(SCHEMA).parquet(path)
    for c in COLUMNS:
        exact = whole.agg(F.count("*"), F.count_if(F.col(c).isNull()), F.min(c).cast("string"), F.max(c).cast("string"), F.countDistinct(c)).first()
        r = got[c]
        assert (r.partitions, r.total_rows, r.nulls, r.least, r.greatest) == (3, *exact[:4])
        # Three standard errors of the sketch; the ids of the days overlap, so sums of counts would be far off.
        assert abs(r.distinct_values - exact[4]) <= 0.05 * exact[4], c
    for share, value in zip((0.25, 0.5, 0.75), got["id"].quartiles):
        assert abs(whole.filter(F.col("id") <= value).count() / 60_000 - share) < 0.03
    assert got["city"].quartiles is None and got["city"].total_bytes == whole.agg(F.sum(F.octet_length("city") + 2)).first()[0]


def test_only_touched_partitions_are_read_and_replaced(spark, table, monkeypatch):
    path, stats = table
    before = {(r.partition_id, r.column_name): r.total_rows for r in st.read_statistics(spark, stats).collect()}
    rows(spark, 500, "2024-01-02", 90_000).write.mode("append").partitionBy("day").parquet(path)
    plans = []
    real = st.collect_statistics
    monkeypatch.setattr(st, "collect_statistics", lambda df, *a: plans.append(explained(df)) or real(df, *a))
    st.refresh_statistics(spark, stats, path, SCHEMA, "day", COLUMNS, [dt.date(2024, 1, 2)])
    assert "PartitionFilters: [" in plans[0] and "day#" in plans[0].split("PartitionFilters: [")[1].split("]")[0]
    after = {(r.partition_id, r.column_name): r.total_rows for r in st.read_statistics(spark, stats).collect()}
    assert after == before | {("2024-01-02", c): 20_500 for c in COLUMNS}
    st.refresh_statistics(spark, stats, path, SCHEMA, "day", COLUMNS, [dt.date(2030, 1, 1), None])
    assert {(r.partition_id, r.column_name): r.total_rows for r in st.read_statistics(spark, stats).collect()} == after


def test_a_partition_that_is_gone_leaves_the_statistics(spark, table):
    from oreline.sources.files import delete_dir

    path, stats = table
    delete_dir(spark, f"{path}/day=2024-01-01")
    st.refresh_statistics(spark, stats, path, SCHEMA, "day", COLUMNS)
    assert {r.partition_id for r in st.read_statistics(spark, stats).collect()} == {"2024-01-02", "__none__"}


def test_questions_read_the_statistics_only(spark, table):
    path, stats = table
    stored = st.read_statistics(spark, stats)
    asked = F.col("partition_id") == "2024-01-02"
    for answer in (st.scan_cost_from_statistics(stored, ["id", "city"], asked), st.advice_from_statistics(stored, COLUMNS), st.partitions_from_statistics(stored)):
        plan = explained(answer)
        assert stats in plan and path not in plan
    cost = st.scan_cost_from_statistics(stored, ["id", "city"], asked, 5.0).first()
    exact = spark.read.schema(SCHEMA).parquet(path).filter("day = date'2024-01-02'").agg(F.sum(F.octet_length("city") + 2) + 8 * F.count("id")).first()[0]
    assert (cost.partitions, cost.bytes_scanned) == (1, exact)
    assert [r.column_name for r in st.advice_from_statistics(stored, COLUMNS).collect()] == ["city", "amount"]
    newest = [(r.partition_id, r.total_rows) for r in st.partitions_from_statistics(stored).collect()]
    assert newest == [("2024-01-02", 20_000), ("2024-01-01", 20_000), (None, 20_000)]


def test_empty_table(spark):
    path, stats = fresh_path(spark, "none"), fresh_path(spark, "none-stats")
    st.refresh_statistics(spark, stats, path, SCHEMA, "day", COLUMNS)
    assert st.table_statistics(st.read_statistics(spark, stats)).collect() == []
    assert st.scan_cost_from_statistics(st.read_statistics(spark, stats), ["id"]).first().bytes_scanned == 0


def test_column_without_values(spark):
    df = spark.range(10).select("id", F.lit(None).cast("decimal(10,2)").alias("amount"), F.lit("x").alias("day"))
    got = {r.column_name: r for r in st.table_statistics(st.collect_statistics(df, "day", ["id", "amount"])).collect()}
    assert (got["amount"].nulls, got["amount"].distinct_values, got["amount"].least, got["amount"].quartiles) == (10, 0, None, None)
