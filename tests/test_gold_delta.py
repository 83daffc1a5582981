"""The aggregate kept by signed changes against a rebuild."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline.operators import gold_delta as gd
from oreline.operators.gold import daily_revenue_by_region
from oreline.operators.merge import delete_partitions, upsert_partitions
from oreline.scratch import fresh_path
from oreline.sources.layout import ByDate
from oreline.sources.publish import read_declared
from tests.ddl import schema as ddl

SCHEMA = ddl("order_id string, order_date date, region string, order_status string, order_amount decimal(18,2), updated_at timestamp, order_date_year date")
BY_YEAR = ByDate("order_date", unit="year")
AT = dt.datetime(2024, 1, 1)


def orders(spark, *rows):
    data = [(i, d and dt.date.fromisoformat(d), r, s, a if a is None else Decimal(a), AT + dt.timedelta(hours=h)) for i, d, r, s, a, h in rows]
    return BY_YEAR.assign(spark.createDataFrame(data, StructType(SCHEMA.fields[:-1])))


BASE = [
    ("a", "2024-01-01", "ASIA", "COMPLETED", "10.00", 0),
    ("b", "2024-01-01", "ASIA", "COMPLETED", "5.50", 0),
    ("c", "2024-01-02", "ASIA", "PENDING", "7.00", 0),
    ("d", "2023-06-01", "EUROPE", "COMPLETED", "1.00", 0),
    ("e", "2022-06-01", "EUROPE", "COMPLETED", "2.00", 0),
    ("f", None, None, "COMPLETED", None, 0),
]
CHANGES = [
    ("a", "2024-01-01", "ASIA", "COMPLETED", "11.00", 1),  # changed
    ("b", "2023-06-01", "ASIA", "COMPLETED", "5.50", 1),  # moved to another year
    ("c", "2024-01-02", "ASIA", "COMPLETED", None, 1),  # now counts, without an amount
    ("d", "2023-06-01", "EUROPE", "CANCELLED", "1.00", 1),  # counts no more: its group goes
    ("g", "2025-01-01", "ASIA", "COMPLETED", "3.00", 1),  # new
]


@pytest.fixture
def stored(spark):
    silver, state = fresh_path(spark, "silver"), fresh_path(spark, "state")
    orders(spark, *BASE).write.partitionBy("order_date_year").parquet(silver)
    gd.build_revenue_state(read_declared(spark, silver, SCHEMA), state, "start")
    return silver, state


def rebuilt(spark, silver):
    return sorted(map(tuple, daily_revenue_by_region(read_declared(spark, silver, SCHEMA)).collect()), key=str)


def served(spark, state):
    return sorted(map(tuple, gd.read_revenue_state(spark, state).collect()), key=str)


def change(spark, silver, *rows, **options):
    return upsert_partitions(spark, silver, "order_date_year", orders(spark, *rows), ["order_id"], SCHEMA, images=gd.IMAGE, **options).images


def test_changes_of_every_kind(spark, stored):
    silver, state = stored
    assert served(spark, state) == rebuilt(spark, silver)
    images = change(spark, silver, *CHANGES)
    assert sorted(r._sign for r in images.collect()) == [-1] * 4 + [1] * 5
    touched = gd.apply_revenue_changes(spark, state, images, "load-1")
    assert [str(t) for t in touched] == ["2023-01-01", "2024-01-01", "2025-01-01"]
    assert served(spark, state) == rebuilt(spark, silver)


def test_a_load_applied_again_changes_nothing(spark, stored):
    silver, state = stored
    images = change(spark, silver, *CHANGES)
    for _ in range(3):
        gd.apply_revenue_changes(spark, state, images, "load-1")
    assert served(spark, state) == rebuilt(spark, silver)


def test_a_stop_between_partitions(spark, stored, monkeypatch):
    """One partition published, then stopped: the next run does the others only."""
    silver, state = stored
    images = change(spark, silver, *CHANGES)
    real = gd.publish_partitions

    def half(content, path, column, touched, schema):
        year = sorted(touched, key=str)[0]
        real(content.filter(F.col(column) == F.lit(year)), path, column, [year], schema=schema)
        raise OSError("stopped")

    monkeypatch.setattr(gd, "publish_partitions", half)
    with pytest.raises(OSError):
        gd.apply_revenue_changes(spark, state, images, "load-1")
    monkeypatch.undo()
    assert len(gd.apply_revenue_changes(spark, state, images, "load-1")) == 2
    assert served(spark, state) == rebuilt(spark, silver)


def test_removed_orders_and_an_emptied_partition(spark, stored):
    silver, state = stored
    gone = orders(spark, *[r for r in BASE if r[0] in "bef"]).select("order_id")
    images = delete_partitions(spark, silver, "order_date_year", gone, ["order_id"], SCHEMA, images=gd.IMAGE).images
    for _ in range(2):
        gd.apply_revenue_changes(spark, state, images, "removal")
    assert served(spark, state) == rebuilt(spark, silver) and len(served(spark, state)) == 2


def test_older_changes_leave_no_trace(spark, stored):
    silver, state = stored
    images = change(spark, silver, ("a", "2020-01-01", "ASIA", "COMPLETED", "99.00", -5), only_if_newer="updated_at")
    assert gd.apply_revenue_changes(spark, state, images, "late") == []
    assert served(spark, state) == rebuilt(spark, silver)


def test_changes_of_another_table_are_an_error(spark, stored):
    silver, state = stored
    images = orders(spark, ("z", "2024-01-01", "ASIA", "COMPLETED", "1.00", 0), ("y", "2024-01-01", "AFRICA", "COMPLETED", "1.00", 0)).select(*gd.IMAGE)
    with pytest.raises(Exception, match="more than the aggregate holds"):
        gd.apply_revenue_changes(spark, state, images.withColumn("_sign", F.lit(-1)), "wrong")


def test_no_order_is_read_again(spark, stored, monkeypatch):
    """Only images and the aggregate: the orders can be gone."""
    from oreline.sources.files import delete_dir

    silver, state = stored
    images = change(spark, silver, *CHANGES)
    expected = rebuilt(spark, silver)
    delete_dir(spark, silver)
    gd.apply_revenue_changes(spark, state, images, "load-1")
    assert served(spark, state) == expected
