import datetime as dt

import pytest
from pyspark.sql import functions as F

from oreline.plans.explain import explained, partition_filters
from oreline.scratch import fresh_path, scratch_root, written
from oreline.sources import model
from oreline.sources.files import partition_dirs
from oreline.sources.layout import (
    ByDate,
    ByIntRange,
    ByLoadDate,
    ByTimestampDate,
    PartitionFilterRequired,
    estimate_scan,
    expire_partitions,
    logical_sizes,
    partition_sizes,
    partition_stats,
    read_partitioned,
    unexpired,
    write_partitioned,
)
from oreline.sources.schemas import ORDERS_PARTITIONED, conform

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    path = fresh_path(spark, "guarded")
    spark.sql(
        "select id, id % 3 as a, date_add(date'2024-01-01', cast(id % 5 as int)) as p from range(100)"
    ).write.partitionBy("p").parquet(path)
    return path


@pytest.mark.parametrize(
    "predicate,allowed",
    [
        ("p = date'2024-01-02'", True),
        ("p between date'2024-01-02' and date'2024-01-03' and a = 1", True),
        ("p in (date'2024-01-02', date'2024-01-04')", True),
        ("year(p) = 2024", True),
        ("a = 1", False),
        ("p = date'2024-01-02' or a = 1", False),
        ("p is not null", False),
    ],
)
def test_guard(spark, table, predicate, allowed):
    if allowed:
        assert read_partitioned(spark, table, predicate=predicate).count() > 0
    else:
        with pytest.raises(PartitionFilterRequired):
            read_partitioned(spark, table, predicate=predicate)
        assert read_partitioned(spark, table, predicate=predicate, require=False).count() > 0


def test_guard_without_any_filter(spark, table):
    with pytest.raises(PartitionFilterRequired):
        read_partitioned(spark, table)


def test_integer_buckets(spark):
    ids = [-1, 0, 499999, 500000, 9999999, 10000000, None]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = {r.id: r.id_bucket for r in ByIntRange("id").assign(df).collect()}
    assert got == {-1: 0, 0: 1, 499999: 1, 500000: 2, 9999999: 20, 10000000: 21, None: None}


def test_integer_range_reads_its_buckets_only(spark):
    path, layout = fresh_path(spark, "ints"), ByIntRange("id")
    df = spark.createDataFrame([(i,) for i in (-1, 999999, 1000000, 1499999, 1500000, 1500001, None)], "id bigint")
    write_partitioned(df, path, layout)
    found = read_partitioned(spark, path, layout, between=(1000000, 1500000))
    assert {r.id for r in found.collect()} == {1000000, 1499999, 1500000}
    assert {r.id_bucket for r in found.collect()} == {3, 4}  # the last id starts the next bucket
    assert "id_bucket" in partition_filters(found)[0]
    assert spark.read.parquet(path).count() == 7


def test_timestamp_range_prunes_days(spark):
    path, layout = fresh_path(spark, "ts"), ByTimestampDate("event_timestamp")
    write_partitioned(model.events(spark, SMALL), path, layout)
    found = read_partitioned(spark, path, layout, between=("2024-01-03 12:00:00", "2024-01-04 01:00:00"))
    assert "event_date" in partition_filters(found)[0]
    plain = model.events(spark, SMALL).filter(
        "event_timestamp between timestamp'2024-01-03 12:00:00' and timestamp'2024-01-04 01:00:00'"
    )
    assert found.count() == plain.count() > 0
    assert len(partition_dirs(spark, path, "event_date")) == 30


def test_load_date_is_given_and_a_repeated_load_replaces_itself(spark):
    path = fresh_path(spark, "loads")
    for _ in range(2):
        for load, rows in (("2024-01-01", 3), ("2024-01-02", 5)):
            write_partitioned(spark.range(rows), path, ByLoadDate(load), dynamic=True)
    assert read_partitioned(spark, path, ByLoadDate(), between=("2024-01-02", "2024-01-02")).count() == 5
    assert spark.read.parquet(path).count() == 8
    with pytest.raises(ValueError):
        ByLoadDate().assign(spark.range(1))


def test_month_layout_keeps_the_date_filter_exact(spark):
    path, layout = fresh_path(spark, "months"), ByDate("order_date", unit="month")
    orders = model.orders(spark, SMALL)
    write_partitioned(orders, path, layout, sort_by=("region", "order_status"))
    found = read_partitioned(spark, path, layout, between=("1996-01-15", "1996-03-10"))
    assert found.count() == orders.filter("order_date between '1996-01-15' and '1996-03-10'").count() > 0
    assert "order_date_month" in partition_filters(found)[0]


def test_sorted_files_and_pushed_filters(spark):
    path, layout = fresh_path(spark, "sorted"), ByDate("order_date", unit="year")
    write_partitioned(model.orders(spark, SMALL), path, layout, sort_by=("region", "order_status"))
    rows = spark.read.parquet(path).select(
        "order_date_year", "region", "order_status", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n")
    )
    by_file = {}
    for r in rows.orderBy("f", "n").collect():
        by_file.setdefault(r.f, []).append((r.region, r.order_status))
    assert all(v == sorted(v) for v in by_file.values())
    picked = read_partitioned(spark, path, layout, between=("1996-01-01", "1996-12-31"), predicate="region = 'ASIA'")
    assert "EqualTo(region,ASIA)" in explained(picked)
    with pytest.raises(ValueError):
        write_partitioned(model.orders(spark, SMALL), path, layout, sort_by=tuple("abcde"))


def test_a_hot_day_is_written_by_many_tasks(spark):
    """One day holds all rows: the writer still spreads it."""
    path = fresh_path(spark, "hot")
    saved = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 400_000, 1, 8).select(
            F.lit("2024-01-01").cast("date").alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("text")
        )
        write_partitioned(rows, path, ByDate("day"))
        files = spark.read.parquet(path).select("_metadata.file_path").distinct().count()
        assert files >= 4
        assert spark.read.parquet(path).count() == 400_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", saved)


def test_missing_required_value_stops_the_write(spark):
    path = fresh_path(spark, "required")
    orders = model.web_orders(spark, SMALL).withColumn("order_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="NULL in NOT NULL column order_id"):
        write_partitioned(orders, path, ByDate("order_date"), schema=ORDERS_PARTITIONED)
    kept = conform(model.web_orders(spark, SMALL), ORDERS_PARTITIONED)
    assert kept.columns == ORDERS_PARTITIONED.fieldNames()


@pytest.mark.parametrize("days_old,kept", [(364, True), (365, True), (366, False)])
def test_expiry_boundary(spark, days_old, kept):
    path, as_of = fresh_path(spark, "expiry"), dt.date(2024, 12, 31)
    date = as_of - dt.timedelta(days=days_old)
    df = spark.createDataFrame([(1, date), (2, as_of), (3, None)], "id int, day date")
    df.write.partitionBy("day").parquet(path)
    assert expire_partitions(spark, path, ByDate("day"), 365, as_of) == ([] if kept else [str(date)])
    assert {r.id for r in spark.read.parquet(path).collect()} == ({1, 2, 3} if kept else {2, 3})
    assert {r.id for r in unexpired(df, "day", 365, as_of).collect()} == ({1, 2} if kept else {2})


@pytest.mark.parametrize("unit,last", [("month", dt.date(2023, 12, 31)), ("year", dt.date(2023, 12, 31)), ("quarter", dt.date(2023, 12, 31))])
@pytest.mark.parametrize("past,kept", [(364, True), (365, True), (366, False)])
def test_expiry_waits_for_the_last_day(spark, unit, last, past, kept):
    path, layout = fresh_path(spark, "expiry"), ByDate("day", unit=unit)
    df = spark.createDataFrame([(1, last), (2, last - dt.timedelta(days=20)), (3, None)], "id int, day date")
    layout.assign(df).write.partitionBy(layout.partition_column).parquet(path)
    expire_partitions(spark, path, layout, 365, last + dt.timedelta(days=past))
    assert {r.id for r in spark.read.parquet(path).collect()} == ({1, 2, 3} if kept else {3})


def test_integer_ranges_do_not_expire(spark):
    with pytest.raises(ValueError, match="integer ranges"):
        expire_partitions(spark, fresh_path(spark, "ints"), ByIntRange("id"), 365, "2024-01-01")


@pytest.mark.parametrize("test", ["cast(p as string) is not null", "year(p) is not null", "p is not null", "coalesce(p, null) is not null"])
def test_not_null_tests_do_not_pass_the_guard(spark, table, test):
    with pytest.raises(PartitionFilterRequired):
        read_partitioned(spark, table, predicate=test)
    assert read_partitioned(spark, table, predicate=f"{test} and p > date'2024-01-04'").count() > 0


def test_logical_bytes(spark):
    df = spark.createDataFrame(
        [(1, "é", dt.date(2024, 1, 1), True, 1.5), (None, None, None, None, None)], "a int, b string, c date, d boolean, e double"
    )
    assert logical_sizes(df, "c").agg(F.sum("total_bytes")).first()[0] == 8 + 4 + 8 + 1 + 8
    assert logical_sizes(df, "c", ("b",)).agg(F.sum("total_bytes")).first()[0] == 4


def test_partition_report(spark, table):
    df = spark.read.parquet(table)
    rows = partition_stats(df, "p", limit=3).collect()
    assert [r.partition_id for r in rows] == ["2024-01-05", "2024-01-04", "2024-01-03"]
    assert all(r.total_rows == 20 and r.size_gb == 0.0 and r.last_modified_time for r in rows)
    sizes = partition_sizes(df, "p")
    total = sum(r.file_size for r in df.select("_metadata.file_path", "_metadata.file_size").distinct().collect())
    assert estimate_scan(sizes).first().bytes_scanned == total
    assert estimate_scan(sizes, "p = date'2024-01-01'").first().partitions == 1
    assert estimate_scan(sizes, "p > date'2030-01-01'").first().bytes_scanned == 0


@pytest.mark.parametrize("size,price", [(100 * 10**9, 0.5), (10**12, 5.0)])
def test_scan_price(spark, size, price):
    sizes = spark.createDataFrame([(size,)], "total_bytes bigint")
    assert estimate_scan(sizes).first().estimated_cost == price


def test_scratch_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == (configured or scratch_root(spark)).rstrip("/")
    table = written(spark.range(3), "probe")
    assert table.count() == 3 and scratch_root(spark) in table.inputFiles()[0]
