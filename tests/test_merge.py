import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline.operators.incremental import (
    FAIL,
    PASS,
    advance_watermark,
    compact_watermarks,
    extract_batch,
    reconcile,
    read_watermarks,
    run_incremental,
    run_pipeline,
    seed_watermarks,
    store_watermarks,
)
from oreline.operators.merge import mark_deleted, merge_upsert, upsert_partitions
from oreline.plans.explain import explained
from oreline.scratch import fresh_path
from oreline.sources.files import data_files, partition_dirs, write_text
from oreline.sources.publish import read_declared
from oreline.sources.schemas import PIPELINE_WATERMARKS

TS = dt.datetime(2024, 1, 1)
TARGET = "id string, amount int, day date, updated_at timestamp, note string"
BATCH = "id string, amount int, day date, updated_at timestamp"


def declared():
    return StructType.fromDDL(TARGET)


def at(hours):
    return TS + dt.timedelta(hours=hours)


def target(spark):
    return spark.createDataFrame(
        [("a", 1, dt.date(2024, 1, 1), at(1), "keep"), ("b", 2, dt.date(2024, 1, 2), at(1), None)], TARGET
    )


def batch(spark, *rows):
    return spark.createDataFrame([(i, v, dt.date(2024, 1, d), at(h)) for i, v, d, h in rows], BATCH)


def rows(df):
    return sorted((r.id or "", r.amount, r.day.day, r.note) for r in df.collect())


def test_update_insert_and_untouched_columns(spark):
    merged = merge_upsert(target(spark), batch(spark, ("a", 10, 3, 2), ("c", 30, 1, 2)), ["id"])
    assert rows(merged) == [("a", 10, 3, "keep"), ("b", 2, 2, None), ("c", 30, 1, None)]


def test_empty_batch_and_replay(spark):
    assert rows(merge_upsert(target(spark), batch(spark).limit(0), ["id"])) == rows(target(spark))
    change = batch(spark, ("a", 10, 3, 2), ("c", 30, 1, 2))
    once = merge_upsert(target(spark), change, ["id"])
    assert rows(merge_upsert(once, change, ["id"])) == rows(once)


def test_repeated_keys(spark):
    twice = batch(spark, ("a", 10, 1, 2), ("a", 11, 1, 3))
    with pytest.raises(ValueError, match="2 rows with one key"):
        merge_upsert(target(spark), twice, ["id"])
    assert ("a", 11, 1, "keep") in rows(merge_upsert(target(spark), twice, ["id"], on_duplicate="latest"))


def test_missing_keys(spark):
    keyless = batch(spark, (None, 5, 1, 2), (None, 5, 1, 2))
    with pytest.raises(ValueError, match="2 rows without a key"):
        merge_upsert(target(spark), keyless, ["id"])
    for mode in ("error", "latest"):
        once = merge_upsert(target(spark), keyless, ["id"], on_null_key="insert", on_duplicate=mode)
        assert once.count() == 4
        assert merge_upsert(once, keyless, ["id"], on_null_key="insert", on_duplicate=mode).count() == 6


def test_only_if_newer_ignores_a_stale_replay(spark):
    stale = batch(spark, ("a", 99, 1, 0), ("b", 20, 2, 5))
    merged = merge_upsert(target(spark), stale, ["id"], only_if_newer="updated_at")
    assert rows(merged) == [("a", 1, 1, "keep"), ("b", 20, 2, None)]


def test_target_with_a_key_twice(spark):
    double = target(spark).unionByName(target(spark))
    merged = merge_upsert(double, batch(spark, ("a", 10, 1, 2)), ["id"])
    assert [r for r in rows(merged) if r[0] == "a"] == [("a", 10, 1, "keep")] * 2


def test_a_column_the_target_lacks(spark):
    with pytest.raises(ValueError, match="not in the target"):
        merge_upsert(target(spark), batch(spark).withColumn("extra", F.lit(1)), ["id"])


def test_a_small_batch_does_not_shuffle_the_target(spark):
    path = fresh_path(spark, "merge-target")
    spark.range(1000).selectExpr("id", "id as v", "timestamp'2024-01-01' as updated_at").write.parquet(path)
    change = spark.range(5).selectExpr("id", "id as v", "timestamp'2024-01-02' as updated_at")
    plan = explained(merge_upsert(spark.read.parquet(path), change, ["id"]), "simple")
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    # The one shuffle makes the target's keys unique, for the search of new ones.
    assert plan.count("Exchange hashpartitioning") == 1


def test_moved_rows_and_emptied_partitions(spark):
    path = fresh_path(spark, "orders")
    target(spark).write.partitionBy("day").parquet(path)
    before = {d: spark.read.parquet(p).inputFiles() for d, p in partition_dirs(spark, path, "day").items()}
    load = upsert_partitions(spark, path, "day", batch(spark, ("a", 10, 3, 2)), ["id"], declared(), report=["day"])
    assert [d.day for d in load.partitions] == [1, 3]
    assert {r.day.day for r in load.moved["day"].collect()} == {1, 3}
    assert set(partition_dirs(spark, path, "day")) == {"2024-01-02", "2024-01-03"}
    assert rows(spark.read.parquet(path)) == [("a", 10, 3, "keep"), ("b", 2, 2, None)]
    left = partition_dirs(spark, path, "day")["2024-01-02"]
    assert spark.read.parquet(left).inputFiles() == before["2024-01-02"]  # not rewritten
    assert upsert_partitions(spark, path, "day", batch(spark).limit(0), ["id"], declared()).partitions == []


def test_text_partitions_and_file_order_survive(spark):
    schema = StructType.fromDDL("id string NOT NULL, amount int, rank int, region string")
    path = fresh_path(spark, "by-region")
    rows = [(f"k{i}", i, 99 - i % 50, f"0{i % 2 + 1}") for i in range(100)]
    first = spark.createDataFrame(rows, "id string, amount int, rank int, region string")
    upsert_partitions(spark, path, "region", first, ["id"], schema, ("rank", "id"))  # creates the table
    change = spark.createDataFrame([("k1", -1, 0, "01"), ("new", 5, 7, "10")], first.schema)
    load = upsert_partitions(spark, path, "region", change, ["id"], schema, ("rank", "id"))
    assert load.partitions == ["01", "02", "10"]
    assert set(partition_dirs(spark, path, "region")) == {"01", "02", "10"}
    after = read_declared(spark, path, schema)
    assert after.count() == 101 and after.filter("region = '01'").count() == 51
    for directory in partition_dirs(spark, path, "region").values():
        for file in spark.read.parquet(directory).inputFiles():
            found = [(r["rank"], r.id) for r in spark.read.parquet(file).collect()]
            assert found == sorted(found)
    keyless = spark.createDataFrame([(None, 1, 1, "01")], first.schema)
    with pytest.raises(Exception, match="NULL in NOT NULL column id"):
        upsert_partitions(spark, path, "region", keyless, ["id"], schema, on_null_key="insert")
    assert read_declared(spark, path, schema).count() == 101


def test_the_search_can_be_bounded(spark):
    path = fresh_path(spark, "bounded")
    upsert_partitions(spark, path, "day", target(spark), ["id"], declared())
    load = upsert_partitions(spark, path, "day", batch(spark, ("b", 7, 2, 2)), ["id"], declared(), within="day = date'2024-01-02'")
    assert [d.day for d in load.partitions] == [2]
    assert rows(read_declared(spark, path, declared())) == [("a", 1, 1, "keep"), ("b", 7, 2, None)]


def test_soft_delete_and_return(spark):
    marked = mark_deleted(target(spark), batch(spark, ("a", 1, 1, 1)), ["id"])
    assert {r.id: r.is_deleted for r in marked.collect()} == {"a": False, "b": True}
    again = mark_deleted(marked, batch(spark, ("a", 1, 1, 1), ("b", 1, 1, 1)), ["id"])
    assert not any(r.is_deleted for r in again.collect())


def test_window_is_open_below_and_closed_above(spark):
    source = batch(spark, ("lo", 1, 1, 0), ("in", 1, 1, 1), ("hi", 1, 1, 2)).unionByName(
        spark.createDataFrame([("after", 1, dt.date(2024, 1, 1), at(2) + dt.timedelta(seconds=1))], BATCH)
    )
    assert {r.id for r in extract_batch(source, at(0), at(2)).collect()} == {"in", "hi"}
    late = extract_batch(source, at(0), at(2), lookback="1 hour")
    assert {r.id for r in late.collect()} == {"lo", "in", "hi"}


def test_watermarks(spark):
    none = spark.createDataFrame([], PIPELINE_WATERMARKS)
    seeds = spark.createDataFrame([("orders", at(0))], "pipeline_name string, last_processed_ts timestamp")
    marks = seed_watermarks(none, seeds, now=at(1))
    assert seed_watermarks(marks, seeds, now=at(2)).collect() == marks.collect()
    moved = advance_watermark(marks, "orders", at(5), 0, "job", now=at(6)).first()
    assert (moved.last_processed_ts, moved.last_run_ts, moved.records_processed) == (at(5), at(6), 0)
    with pytest.raises(ValueError, match="no watermark"):
        advance_watermark(marks, "other", at(5), 0, "job")


def test_reconciliation_reports_lost_rows(spark):
    source = batch(spark, ("a", 1, 1, 1), ("b", 1, 1, 1), ("c", 1, 1, 1))
    short = source.filter("id != 'c'")
    row = reconcile(source, short, source.filter("id = 'a'"), ["id"], at(0), at(2)).first()
    assert (row.source_records, row.loaded_records, row.target_records, row.discrepancy) == (3, 2, 1, 1)
    assert row.reconciliation_status == FAIL
    assert reconcile(source, source, source, ["id"], at(0), at(2)).first().reconciliation_status == PASS


def test_an_incremental_run_twice(spark):
    path = fresh_path(spark, "silver")
    empty = "id string, amount int, updated_at timestamp, _silver_updated_at timestamp, _ingestion_date date, day date"
    spark.createDataFrame(
        [("a", 1, at(0), at(0), dt.date(2024, 1, 1), dt.date(2024, 1, 1))], empty
    ).write.partitionBy("day").parquet(path)
    schema = StructType.fromDDL(empty)
    source = batch(spark, ("a", 10, 2, 1), ("b", 20, 2, 2), ("late", 1, 2, 9))
    for _ in range(2):
        load = run_incremental(spark, source, path, "day", ["id"], at(0), at(2), "2024-02-01", schema, now=at(3))
        assert load.records == 2
        assert load.reconciliation.first().reconciliation_status == PASS
        stored = {r.id: (r.amount, r.day.day, r._ingestion_date.month) for r in spark.read.parquet(path).collect()}
        assert stored == {"a": (10, 2, 2), "b": (20, 2, 2)}
    assert [d.day for d in load.touched_partitions] == [2]


def test_the_watermark_moves_only_after_a_run_that_worked(spark):
    path, marks = fresh_path(spark, "silver"), fresh_path(spark, "marks")
    schema = StructType.fromDDL("id string, amount int, updated_at timestamp, _silver_updated_at timestamp, _ingestion_date date, day date")
    seeds = spark.createDataFrame([("orders", at(0)), ("other", at(0))], "pipeline_name string, last_processed_ts timestamp")
    store_watermarks(seed_watermarks(read_watermarks(spark, marks), seeds, now=at(0)), marks)
    settings = {"target_path": path, "partition_column": "day", "keys": ["id"], "run_date": "2024-02-01", "schema": schema}
    good = batch(spark, ("a", 1, 1, 1), ("b", 2, 2, 3))
    twice = batch(spark, ("a", 1, 1, 1), ("a", 2, 1, 1))

    def mark(name):
        return {r.pipeline_name: r.last_processed_ts for r in read_watermarks(spark, marks).collect()}[name]

    with pytest.raises(ValueError, match="one key"):
        run_pipeline(spark, "orders", twice, marks, at(2), "job", **settings)
    assert mark("orders") == at(0)
    assert run_pipeline(spark, "orders", good, marks, at(2), "job", **settings).records == 1
    assert run_pipeline(spark, "orders", good, marks, at(4), "job", **settings).records == 1
    assert (mark("orders"), mark("other")) == (at(4), at(0))
    assert {r.id for r in read_declared(spark, path, schema).collect()} == {"a", "b"}
    with pytest.raises(ValueError, match="no watermark"):
        run_pipeline(spark, "unknown", good, marks, at(4), "job", **settings)


def marks_of(spark, path):
    return {r.pipeline_name: r.last_processed_ts for r in read_watermarks(spark, path).collect()}


def test_marks_are_only_ever_added(spark):
    """Two pipelines that read the same marks and end together lose nothing; a half-written mark does not count."""
    path = fresh_path(spark, "marks")
    seeds = spark.createDataFrame([("a", at(0)), ("b", at(0))], "pipeline_name string, last_processed_ts timestamp")
    store_watermarks(seed_watermarks(read_watermarks(spark, path), seeds, now=at(0)), path)
    before = data_files(spark, path)
    seen = read_watermarks(spark, path)
    ends = [advance_watermark(seen.filter(F.col("pipeline_name") == p), p, at(h), 1, "job", now=at(h)) for p, h in (("a", 5), ("b", 3))]
    for end in ends:
        store_watermarks(end, path)
    assert marks_of(spark, path) == {"a": at(5), "b": at(3)}
    assert set(before) < set(data_files(spark, path))
    store_watermarks(read_watermarks(spark, path), path)
    assert len(data_files(spark, path)) == len(before) + 2  # nothing differed, nothing was written
    write_text(spark, f"{path}/_temporary/0/_temporary/attempt_1/part-lost.parquet", "half a file")
    assert marks_of(spark, path) == {"a": at(5), "b": at(3)}
    back = advance_watermark(read_watermarks(spark, path).filter("pipeline_name = 'a'"), "a", at(1), 1, "reset", now=at(2))
    store_watermarks(back, path)
    assert marks_of(spark, path)["a"] == at(1)  # set back on purpose: the latest mark counts, not the greatest


def test_compacted_marks(spark, monkeypatch):
    path = fresh_path(spark, "marks")
    seeds = spark.createDataFrame([("a", at(0)), ("b", at(0))], "pipeline_name string, last_processed_ts timestamp")
    store_watermarks(seed_watermarks(read_watermarks(spark, path), seeds, now=at(0)), path)
    for hour in (1, 2, 3):
        store_watermarks(advance_watermark(read_watermarks(spark, path), "a", at(hour), 1, "job", now=at(hour)), path)
    monkeypatch.setattr("oreline.operators.incremental.delete_dir", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        compact_watermarks(spark, path)
    monkeypatch.undo()
    assert marks_of(spark, path) == {"a": at(3), "b": at(0)}
    assert compact_watermarks(spark, path) >= 5 and len(data_files(spark, path)) == 1
    assert marks_of(spark, path) == {"a": at(3), "b": at(0)}
    store_watermarks(advance_watermark(read_watermarks(spark, path), "b", at(9), 1, "job", now=at(9)), path)
    assert marks_of(spark, path) == {"a": at(3), "b": at(9)}
