import datetime as dt

import pytest
from pyspark.sql import functions as F

from oreline.operators import scd2_apart
from oreline.operators.scd2 import (
    scd2_apply,
    scd2_as_of,
    scd2_asof_join,
    scd2_current,
    scd2_integrity,
    scd2_publish,
    scd2_version_counts,
)
from oreline.plans.dimension_queries import KEY, TRACKED, _history
from oreline.plans.explain import explained, partition_filters
from oreline.scratch import fresh_path, written
from oreline.sources.files import partition_dirs
from oreline.sources.layout import ByDate
from oreline.sources.publish import publish_version, read_declared
from oreline.sources.schemas import DIM_CUSTOMER, DIM_CUSTOMER_APART, DIM_CUSTOMER_STORED, create_table

OPEN = dt.date(9999, 12, 31)
DAY1, DAY2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
SOURCE = "customer_id string, city string, state string, customer_name string, customer_segment string"


def empty(spark):
    return spark.createDataFrame([], DIM_CUSTOMER)


def source(spark, *rows):
    return spark.createDataFrame([(c, city, "S", "N", seg) for c, city, seg in rows], SOURCE)


def apply(spark, dim, day, *rows, **options):
    return scd2_apply(dim, source(spark, *rows), KEY, TRACKED, day, **options)


def versions(df):
    rows = df.collect()
    found = {(r.customer_id, r.city, r.customer_segment, r.valid_from, r.valid_to, r.is_current) for r in rows}
    assert len(found) == len(rows)
    return found


def base(spark):
    first = (("moves", "A", "X"), ("same", "A", "X"), ("absent", "A", "X"), ("null", "A", None))
    return written(apply(spark, empty(spark), DAY1, *first), "dim")


def test_first_load_keys(spark):
    rows = base(spark).collect()
    assert {r._scd_key for r in rows} == {f"{c}_2024-01-01" for c in ("moves", "same", "absent", "null")}
    assert all(r.is_current and r.valid_to == OPEN for r in rows)


def test_change_new_same_and_absent(spark):
    changes = (("moves", "B", "X"), ("same", "A", "X"), ("new", "C", "X"), ("null", "A", "X"))
    after = apply(spark, base(spark), DAY2, *changes)
    assert versions(after) == {
        ("moves", "A", "X", DAY1, dt.date(2024, 1, 31), False),
        ("moves", "B", "X", DAY2, OPEN, True),
        ("same", "A", "X", DAY1, OPEN, True),
        ("absent", "A", "X", DAY1, OPEN, True),
        ("new", "C", "X", DAY2, OPEN, True),
        ("null", "A", None, DAY1, OPEN, True),  # inequality does not see a change from NULL
    }
    safe = apply(spark, base(spark), DAY2, ("null", "A", "X"), mode="null_safe")
    assert {(r.customer_segment, r.is_current) for r in safe.filter("customer_id = 'null'").collect()} == {
        (None, False),
        ("X", True),
    }


def test_same_date_again_changes_nothing(spark):
    once = written(apply(spark, base(spark), DAY2, ("moves", "B", "X"), ("new", "C", "X")), "dim")
    again = apply(spark, once, DAY2, ("moves", "B", "X"), ("new", "C", "X"))
    assert again.exceptAll(once).isEmpty() and once.exceptAll(again).isEmpty()


def test_key_with_closed_versions_only_is_new(spark):
    closed = base(spark).withColumns({"is_current": F.lit(False), "valid_to": F.lit("2024-01-10").cast("date")})
    after = apply(spark, closed, DAY2, ("moves", "A", "X"))
    found = {(r.valid_from, r.is_current) for r in after.filter("customer_id = 'moves'").collect()}
    assert found == {(DAY1, False), (DAY2, True)}


def test_source_with_a_key_twice_fails(spark):
    with pytest.raises(ValueError, match="rows with one key"):
        apply(spark, base(spark), DAY2, ("moves", "B", "X"), ("moves", "C", "X"))


def test_lookups_around_a_change(spark):
    dim = written(apply(spark, base(spark), DAY2, ("moves", "B", "X")), "dim").filter("customer_id = 'moves'")

    def city(day, inclusive=False):
        return [r.city for r in scd2_as_of(dim, day, inclusive).collect()]

    last = dt.date(2024, 1, 31)
    assert city(DAY1) == ["A"] and city(dt.date(2024, 1, 30)) == ["A"]
    assert city(last) == [] and city(last, inclusive=True) == ["A"]
    assert city(DAY2) == ["B"] and city(DAY2, inclusive=True) == ["B"]
    assert [r.city for r in scd2_current(dim).collect()] == ["B"]
    counts = scd2_version_counts(dim, KEY).first()
    assert (counts.version_count, counts.first_seen, counts.latest_change) == (2, DAY1, DAY2)


def test_history_has_no_gap_or_overlap(spark):
    dim = _history(spark, "/root/testdata/sf0.001")
    assert scd2_integrity(dim, KEY).isEmpty()
    days = dim.groupBy(KEY).agg(
        F.sum(F.datediff("valid_to", "valid_from") + 1).alias("covered"),
        (F.datediff(F.max("valid_to"), F.min("valid_from")) + 1).alias("span"),
    )
    assert days.filter("covered != span").isEmpty()


def test_two_changes_on_one_date_are_reported(spark):
    once = written(apply(spark, base(spark), DAY2, ("moves", "B", "X")), "dim")
    twice = apply(spark, once, DAY2, ("moves", "C", "X"))
    found = {(r.customer_id, r.violation, r.found) for r in scd2_integrity(twice, KEY).collect()}
    assert found == {("moves", "reversed_interval", 1), ("moves", "repeated_scd_key", 1)}


def test_overlap_and_double_current_are_reported(spark):
    dim = base(spark)
    later = dim.filter("customer_id = 'same'").withColumn("valid_from", F.lit("2024-01-15").cast("date"))
    bad = dim.unionByName(later)
    found = {(r.violation, r.found) for r in scd2_integrity(bad, KEY).collect()}
    assert found == {("overlap", 1), ("several_current", 2), ("repeated_scd_key", 1)}


def test_asof_join_gives_the_same_for_busy_keys(spark):
    """A key with a version per day, joined by month and plainly."""
    days = spark.sql("select explode(sequence(date'2023-01-01', date'2023-12-31')) as valid_from")
    busy = days.select(
        F.lit("busy").alias(KEY),
        F.date_format("valid_from", "yyyyMMdd").alias("city"),
        "valid_from",
        F.when(F.col("valid_from") == "2023-12-31", F.lit(OPEN)).otherwise(F.col("valid_from")).alias("valid_to"),
    )
    calm = spark.createDataFrame(
        [("calm", "A", dt.date(2023, 1, 1), dt.date(2023, 6, 30)), ("calm", "B", dt.date(2023, 7, 1), OPEN)],
        busy.schema,
    )
    dim = written(busy.unionByName(calm), "dim")
    dates = spark.sql("select explode(sequence(date'2022-12-15', date'2024-01-15')) as order_date")
    facts = dates.select("order_date", F.explode(F.array(F.lit("busy"), F.lit("calm"), F.lit("none"))).alias(KEY))
    joined = scd2_asof_join(facts, dim, KEY, "order_date", ["city"])
    by_month = scd2_asof_join(facts, dim, KEY, "order_date", ["city"], unit="MONTH")
    during = "k = customer_id and order_date between valid_from and valid_to"
    plain = facts.join(dim.withColumnRenamed(KEY, "k"), F.expr(during)).select("order_date", KEY, "city")
    assert plain.count() == 2 * (365 + 15) and joined.columns == by_month.columns == ["order_date", KEY, "city"]
    for df in (joined, by_month):
        assert df.exceptAll(plain).isEmpty() and plain.exceptAll(df).isEmpty()
    none = scd2_asof_join(facts.limit(0), dim, KEY, "order_date", ["city"])
    assert none.isEmpty() and none.columns == joined.columns
    assert scd2_asof_join(facts, dim.limit(0), KEY, "order_date", ["city"]).isEmpty()


def test_a_stored_run_rewrites_only_partitions_with_a_change(spark):
    path, layout = fresh_path(spark, "dim"), ByDate("valid_from", unit="year")

    def run(date, *rows):
        source = spark.createDataFrame([(k, c, "S", n, "seg") for k, c, n in rows], "customer_id string, city string, state string, customer_name string, customer_segment string")
        return scd2_publish(spark, path, source, KEY, TRACKED, date, DIM_CUSTOMER_STORED, layout)

    def files():
        return {d: sorted(spark.read.parquet(p).inputFiles()) for d, p in partition_dirs(spark, path, "valid_from_year").items()}

    run("2020-05-01", ("a", "A", "x"), ("b", "B", "y"))  # the first run creates the table
    run("2021-05-01", ("c", "C", "z"))
    before = files()
    assert [d.year for d in run("2022-02-02", ("c", "C2", "z"), ("b", "B", "y"))] == [2021, 2022]
    assert files()["2020-01-01"] == before["2020-01-01"]
    once = files()
    assert run("2022-02-02", ("c", "C2", "z"), ("b", "B", "y")) == [] and files() == once
    rows = read_declared(spark, path, DIM_CUSTOMER_STORED).collect()
    found = {(r.customer_id, r.city, str(r.valid_from), str(r.valid_to), r.is_current) for r in rows}
    assert found == {
        ("a", "A", "2020-05-01", "9999-12-31", True), ("b", "B", "2020-05-01", "9999-12-31", True),
        ("c", "C", "2021-05-01", "2022-02-01", False), ("c", "C2", "2022-02-02", "9999-12-31", True),
    }
    with pytest.raises(ValueError, match="one key"):
        run("2022-02-02", ("c", "C3", "z"))


def test_publish_switches_the_table(spark):
    first, second = fresh_path(spark, "dim-v1"), fresh_path(spark, "dim-v2")
    spark.sql("DROP TABLE IF EXISTS dim_customer_test")
    create_table(spark, "dim_customer_test", DIM_CUSTOMER, first, description="customers' history")
    publish_version(apply(spark, spark.table("dim_customer_test"), DAY1, ("a", "A", "X")), "dim_customer_test", second)
    assert spark.table("dim_customer_test").count() == 1
    third = fresh_path(spark, "dim-v3")
    after = apply(spark, spark.table("dim_customer_test"), DAY2, ("a", "B", "X"))
    publish_version(after, "dim_customer_test", third, sort_by=("customer_id", "is_current"))
    assert spark.table("dim_customer_test").count() == 2
    spark.sql("DROP TABLE dim_customer_test")


# --- current versions apart


def published(spark, path, day, *rows, **options):
    return scd2_apart.publish_apart(spark, path, source(spark, *rows), KEY, TRACKED, day, DIM_CUSTOMER_APART, **options)


def test_current_versions_apart(spark):
    """The same versions as a run over the whole table; a run reads the open year and writes that and its own."""
    path = fresh_path(spark, "apart")
    changes = (("moves", "B", "X"), ("same", "A", "X"), ("new", "C", "X"), ("null", "A", "X"))
    scd2_apart.build_apart(base(spark), path, KEY, DIM_CUSTOMER)
    assert published(spark, path, DAY2, *changes, mode="null_safe") == 5
    assert published(spark, path, DAY2, *changes, mode="null_safe") == 0
    stored = read_declared(spark, path, DIM_CUSTOMER_APART)
    assert versions(stored) == versions(apply(spark, base(spark), DAY2, *changes, mode="null_safe"))
    assert set(partition_dirs(spark, path, "valid_to_year")) == {"9999-01-01", "2024-01-01"}
    published(spark, path, dt.date(2026, 1, 1), ("moves", "Z", "X"))
    assert set(partition_dirs(spark, path, "valid_to_year")) == {"9999-01-01", "2024-01-01", "2025-01-01"}
    current = scd2_apart.current_versions(spark, path, DIM_CUSTOMER_APART)
    assert "9999-01-01" in partition_filters(current)[0] and current.filter("not is_current").isEmpty()
    for day in (DAY1, DAY2, dt.date(2024, 1, 31), dt.date(2025, 12, 31), dt.date(2030, 1, 1)):
        assert versions(scd2_apart.stored_as_of(spark, path, DIM_CUSTOMER_APART, day)) == versions(scd2_as_of(read_declared(spark, path, DIM_CUSTOMER_APART), day, True))


def test_a_run_apart_that_stops(spark, monkeypatch):
    """Closed versions appended, then stopped: the next run does not append them again."""
    path = fresh_path(spark, "apart")
    scd2_apart.build_apart(base(spark), path, KEY, DIM_CUSTOMER)
    monkeypatch.setattr(scd2_apart, "publish_partitions", lambda *a, **b: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        published(spark, path, DAY2, ("moves", "B", "X"))
    monkeypatch.undo()
    assert published(spark, path, DAY2, ("moves", "B", "X")) == 2
    assert versions(read_declared(spark, path, DIM_CUSTOMER_APART)) == versions(apply(spark, base(spark), DAY2, ("moves", "B", "X")))
    with pytest.raises(Exception, match="on the date of the first"):
        published(spark, path, DAY2, ("moves", "C", "X"))


def test_lookup_after_the_last_change_is_one_unit(spark):
    """Facts long after anything changed, and facts before: one version each, with the facts read once."""
    dim = apply(spark, base(spark), DAY2, ("moves", "B", "X"))
    facts = spark.createDataFrame([("moves", d) for d in (DAY1, DAY2, dt.date(2024, 1, 31), dt.date(2099, 7, 1), dt.date(2000, 1, 1))], "customer_id string, day date")
    joined = scd2_asof_join(facts, written(dim, "dim"), KEY, "day", ("city",))
    assert {(r.day, r.city) for r in joined.collect()} == {(DAY1, "A"), (DAY2, "B"), (dt.date(2024, 1, 31), "A"), (dt.date(2099, 7, 1), "B")}
    assert scd2_asof_join(facts, empty(spark), KEY, "day", ("city",)).collect() == []


def test_versions_laid_out_are_not_broadcast(spark):
    """A long history in small files: laid out by unit it is many times what Spark takes it for."""
    dim = spark.range(2000).select(
        F.col("id").cast("string").alias(KEY), F.lit("x").alias("city"),
        F.lit("1990-01-01").cast("date").alias("valid_from"), F.lit("9999-12-31").cast("date").alias("valid_to"),
    )
    ended = dim.withColumns({"valid_from": F.lit("1950-01-01").cast("date"), "valid_to": F.lit("1989-12-31").cast("date")})
    facts = spark.range(4000).select((F.col("id") % 2500).cast("string").alias(KEY), F.lit("1975-05-05").cast("date").alias("day"))
    joined = scd2_asof_join(facts, written(ended.unionByName(dim), "dim"), KEY, "day", ("city",))
    plan = explained(joined, "simple")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert joined.count() == 3500 and joined.filter("city != 'x'").isEmpty()
