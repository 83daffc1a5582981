"""Late, repeated and out-of-order changes of a dimension."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from oreline.operators import scd2_late as late
from oreline.operators.scd2 import scd2_integrity
from oreline.plans.dimension_queries import BY_START, KEY, TRACKED
from oreline.scratch import fresh_path
from oreline.sources.files import partition_dirs
from oreline.sources.publish import read_declared
from oreline.sources.schemas import DIM_CUSTOMER_STORED

CHANGE = "customer_id string, city string, state string, customer_name string, customer_segment string, effective date, recorded_at timestamp"
OPEN = dt.date(9999, 12, 31)


def changes(spark, *rows):
    """(customer, city, effective date, hour it was recorded)."""
    data = [(c, city, "S", "N", None, dt.date.fromisoformat(d) if d else None, dt.datetime(2025, 1, 1) + dt.timedelta(hours=h)) for c, city, d, h in rows]
    return spark.createDataFrame(data, CHANGE)


def run(spark, *batches):
    dim, log = fresh_path(spark, "dim"), fresh_path(spark, "log")
    for batch in batches:
        splice(spark, dim, log, batch)
    return dim, log


def splice(spark, dim, log, batch):
    return late.splice_changes(spark, dim, log, changes(spark, *batch), KEY, TRACKED, DIM_CUSTOMER_STORED, BY_START, buckets=4)


def versions(spark, dim):
    stored = read_declared(spark, dim, DIM_CUSTOMER_STORED)
    assert scd2_integrity(stored, KEY).isEmpty()
    assert stored.filter(F.col("valid_from_year") != F.trunc("valid_from", "year")).isEmpty()
    return sorted((r.customer_id, r.city, str(r.valid_from), str(r.valid_to), r.is_current) for r in stored.collect())


def test_a_late_change_splits_a_version(spark):
    dim, _ = run(spark, [("a", "X", "2020-01-01", 0), ("b", "X", "2020-01-01", 0)], [("a", "Z", "2024-01-01", 1)], [("a", "Y", "2022-03-05", 2)])
    assert versions(spark, dim) == [
        ("a", "X", "2020-01-01", "2022-03-04", False),
        ("a", "Y", "2022-03-05", "2023-12-31", False),
        ("a", "Z", "2024-01-01", "9999-12-31", True),
        ("b", "X", "2020-01-01", "9999-12-31", True),
    ]
    keys = {r._scd_key for r in read_declared(spark, dim, DIM_CUSTOMER_STORED).collect()}
    assert keys == {"a_2020-01-01", "a_2022-03-05", "a_2024-01-01", "b_2020-01-01"}


def test_before_all_history_and_equal_neighbours(spark):
    dim, _ = run(spark, [("a", "X", "2020-01-01", 0)], [("a", "W", "2019-01-01", 1)], [("a", "X", "2021-01-01", 2)])
    assert versions(spark, dim) == [("a", "W", "2019-01-01", "2019-12-31", False), ("a", "X", "2020-01-01", "9999-12-31", True)]
    # The change of 2021 changed nothing then; now that one before it does, it counts.
    dim, _ = run(spark, [("a", "X", "2020-01-01", 0)], [("a", "X", "2021-01-01", 1)], [("a", "Y", "2020-06-01", 2)])
    assert [v[1:3] for v in versions(spark, dim)] == [("X", "2020-01-01"), ("X", "2021-01-01"), ("Y", "2020-06-01")]


def test_the_second_change_of_a_date_replaces_the_first(spark):
    dim, _ = run(spark, [("a", "X", "2020-01-01", 0), ("a", "Y", "2021-01-01", 1)], [("a", "Z", "2021-01-01", 2)], [("a", "OLD", "2021-01-01", 1)])
    assert [v[1:3] for v in versions(spark, dim)] == [("X", "2020-01-01"), ("Z", "2021-01-01")]
    # A correction that takes a change back joins the versions again.
    dim, _ = run(spark, [("a", "X", "2020-01-01", 0), ("a", "Y", "2021-01-01", 1)], [("a", "X", "2021-01-01", 2)])
    assert versions(spark, dim) == [("a", "X", "2020-01-01", "9999-12-31", True)]


def test_any_order_of_arrival_gives_one_dimension(spark):
    rng = random.Random(4)
    all_rows = [(rng.choice("ab"), rng.choice("XY"), f"202{rng.randint(0, 3)}-0{rng.randint(1, 2)}-01", h) for h in range(8)]
    found = set()
    for order in itertools.islice(itertools.permutations(range(8)), 0, 40320, 16000):
        picked = [all_rows[i] for i in order]
        dim, _ = run(spark, picked[:3], picked[3:5], picked[5:])
        stored = read_declared(spark, dim, DIM_CUSTOMER_STORED)
        versions(spark, dim)
        found.add(tuple(sorted(map(str, stored.collect()))))
    assert len(found) == 1


def test_only_partitions_that_differ_are_rewritten(spark):
    dim, log = run(spark, [("a", "X", "2020-01-01", 0), ("b", "X", "2021-01-01", 0), ("c", "X", "2023-05-01", 0)])
    years = [str(y)[:4] for y in splice(spark, dim, log, [("a", "Y", "2022-03-05", 1)])]
    assert years == ["2020", "2022"]
    assert splice(spark, dim, log, [("a", "Y", "2022-03-05", 1)]) == []
    assert set(partition_dirs(spark, dim, BY_START.partition_column)) == {f"{y}-01-01" for y in (2020, 2021, 2022, 2023)}
    assert [str(y)[:4] for y in splice(spark, dim, log, [("a", "X", "2022-03-05", 2)])] == ["2020", "2022"]
    assert set(partition_dirs(spark, dim, BY_START.partition_column)) == {f"{y}-01-01" for y in (2020, 2021, 2023)}


def test_a_stop_before_the_log_is_published(spark, monkeypatch):
    first, second = [("a", "X", "2020-01-01", 0), ("b", "X", "2020-01-01", 0)], [("a", "Y", "2019-02-01", 1), ("b", "Z", "2021-01-01", 1)]
    whole, _ = run(spark, first, second)
    dim, log = run(spark, first)
    real, calls = late.publish_partitions, []

    def stop(*args, **options):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("stopped")
        return real(*args, **options)

    monkeypatch.setattr(late, "publish_partitions", stop)
    with pytest.raises(OSError):
        splice(spark, dim, log, second)
    monkeypatch.undo()
    splice(spark, dim, log, second)
    assert versions(spark, dim) == versions(spark, whole)


def test_changes_without_key_or_date(spark):
    for bad in (("a", "X", None, 0), (None, "X", "2020-01-01", 0)):
        with pytest.raises(Exception, match="without key or date"):
            run(spark, [bad])
    assert run(spark, []) and True
