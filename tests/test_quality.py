import datetime as dt

import pytest
from pyspark.sql import functions as F

from oreline.operators import quality as q
from oreline.plans.explain import explained
from oreline.scratch import fresh_path
from oreline.sources import model

TODAY, BEFORE = dt.date(2024, 1, 2), dt.date(2024, 1, 1)
SCHEMA = "order_id string, order_status string, _ingestion_date date"
SMALL = "/root/testdata/sf0.001"


def day(count, date, prefix="k"):
    return [(f"{prefix}{i}", "PENDING", date) for i in range(count)]


def check(spark, rows, *checks, date=TODAY):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.check_name: r for r in q.run_checks(df, "t", "p", checks or q.ORDER_CHECKS, date).collect()}


@pytest.mark.parametrize(
    "today,before,passed",
    [(130, 100, True), (131, 100, False), (70, 100, True), (69, 100, False), (5, 0, True)],
)
def test_drift(spark, today, before, passed):
    row = check(spark, day(today, TODAY) + day(before, BEFORE), q.Drift())["row_count_drift"]
    assert row.status == ("PASSED" if passed else "FAILED")
    assert (row.actual_value is None) == (before == 0)
    if before:
        change = abs(today - before) / before * 100
        assert row.actual_value == f"{change:.1f}% change"
        assert row.message == f"Today: {today} | Yesterday: {before} | Change: {change:.1f}%"


def test_missing_key_counts_as_duplicate_unless_skipped(spark):
    rows = [("a", "PENDING", TODAY), ("a", "PENDING", TODAY), (None, "PENDING", TODAY)]
    row = check(spark, rows, q.Unique("u", column="order_id"))["u"]
    assert row.message == "Total: 3 | Unique keys: 1 | Duplicates: 2"
    row = check(spark, rows, q.Unique("u", column="order_id", skip_nulls=True))["u"]
    assert row.message == "Total: 2 | Unique keys: 1 | Duplicates: 1"


def test_valid_values_leave_missing_ones_alone(spark):
    rows = [("a", "COMPLETED", TODAY), ("b", None, TODAY), ("c", "REFUNDED", TODAY)]
    row = check(spark, rows)["order_status_valid_values"]
    assert row.status == "FAILED" and row.actual_value == "1 records with unexpected status"


def test_an_empty_day(spark):
    found = check(spark, day(3, BEFORE))
    assert found["not_empty"].status == "FAILED"
    assert found["not_empty"].message == "CRITICAL: Table is empty — upstream pipeline likely failed"
    assert found["row_count_drift"].actual_value == "100.0% change"
    assert {n for n, r in found.items() if r.status == "FAILED"} == {"not_empty", "row_count_drift"}


def test_gate(spark):
    def passes(rows):
        return q.gate(q.run_checks(spark.createDataFrame(rows, SCHEMA), "t", "p", q.ORDER_CHECKS, TODAY))

    assert passes(day(100, TODAY) + day(10, BEFORE))  # drift alone is a warning
    assert not passes(day(10, TODAY) + [(None, "PENDING", TODAY)])
    assert not passes(day(10, BEFORE))
    assert not q.gate(spark.createDataFrame([], "severity string, status string"))


def test_validation_leaves_the_log_and_decides(spark):
    path = fresh_path(spark, "validation")
    df = spark.createDataFrame(day(3, TODAY) + [("k0", "PENDING", BEFORE), ("k0", "PENDING", BEFORE)], SCHEMA)
    assert q.run_validation(df, "orders", "order_id", TODAY, path)
    assert not q.run_validation(df, "orders", "order_id", BEFORE, path)
    assert spark.read.parquet(path).groupBy("run_date").count().count() == 2


def test_a_whole_table_has_a_run_for_rows_without_a_date(spark):
    rows = day(2, TODAY) + day(1, TODAY + dt.timedelta(days=2)) + [("n", "PENDING", None)]
    found = q.run_checks(spark.createDataFrame(rows, SCHEMA), "t", "p", [q.NotEmpty()]).collect()
    counts = {r.run_date: r.message.split()[-1] for r in found if r.status == "PASSED"}
    assert counts == {TODAY: "2", TODAY + dt.timedelta(days=2): "1", None: "1"} and len(found) == 4
    assert q.run_checks(spark.createDataFrame([], SCHEMA), "t", "p", q.ORDER_CHECKS).isEmpty()
    undated = q.run_checks(spark.createDataFrame([("n", "PENDING", None)], SCHEMA), "t", "p", q.ORDER_CHECKS)
    assert undated.count() == 5


def test_validator_report(spark):
    df = spark.createDataFrame([("a", "X", TODAY), ("a", "X", TODAY)], SCHEMA)
    report = {r.check_name: r for r in q.validate_table(df, "orders", "order_id", TODAY).collect()}
    assert report["orders.row_count"].message == "Row count for 2024-01-02: 2"
    assert report["orders.order_id_not_null"].actual == "0 nulls"
    duplicates = report["orders.order_id_no_duplicates"]
    assert (duplicates.status, duplicates.message) == ("FAILED", "Total: 2 | Unique: 1 | Dupes: 1")
    assert not q.gate(q.validate_table(df, "orders", "order_id", TODAY))


def test_a_range_gives_what_single_days_give(spark):
    lines = model.order_lines(spark, SMALL)
    columns = ("run_date", "check_name", "status", "actual_value", "message")
    ranged = q.run_checks(lines, "t", "p", q.ORDER_CHECKS, "1996-03-01", "1996-03-05").select(*columns)
    for date in ("1996-03-01", "1996-03-04"):
        single = q.run_checks(lines, "t", "p", q.ORDER_CHECKS, date).select(*columns)
        assert single.count() == 5
        assert single.exceptAll(ranged.filter(F.col("run_date") == date)).isEmpty()
    assert ranged.count() == 25


def test_one_scan_with_the_day_filter_pushed_down(spark):
    path = fresh_path(spark, "lines")
    model.order_lines(spark, SMALL).write.parquet(path)
    results = q.run_checks(spark.read.parquet(path), "t", "p", q.ORDER_CHECKS, "1996-03-01", "1996-03-05")
    plan = explained(results)
    assert plan.count("Scan parquet") == 2  # one in the tree, one in its description
    assert "GreaterThanOrEqual(_ingestion_date,1996-02-29)" in plan
    assert "SinglePartition" not in plan


def test_log_and_summary(spark):
    path = fresh_path(spark, "log")
    df = spark.createDataFrame(day(3, TODAY) + [(None, "ODD", TODAY)] + day(9, BEFORE), SCHEMA)
    for date in (BEFORE, TODAY):
        q.append_log(q.run_checks(df, "orders_silver", "p", q.ORDER_CHECKS, date), path)
    log = spark.read.parquet(path)
    assert log.count() == 10 and log.select("check_id").distinct().count() == 10
    order = [(r.severity, r.status) for r in q.dq_summary(log, TODAY).collect()]
    assert order == [("CRITICAL", "FAILED")] * 2 + [("CRITICAL", "PASSED")] + [("WARNING", "FAILED")] * 2


def test_unknown_check_has_no_outcome():
    with pytest.raises(NotImplementedError):
        q.Check("x").outcome()
