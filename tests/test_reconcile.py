"""Keys that differ, and the ledger that finds changes without a time."""

import pytest
from pyspark.sql import functions as F

from oreline.operators import reconcile as rec
from oreline.operators.ledger import BUCKET, extract_by_ledger, ledger_schema, store_ledger
from oreline.plans.explain import explained
from oreline.scratch import fresh_path
from oreline.sources.publish import read_declared

COLUMNS = ["id", "amount", "note"]


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, amount int, note string")


def found(report):
    return {r.id: (r.status, r.differing_columns) for r in report.keys.collect()}


def test_every_kind_of_difference(spark):
    same = [(f"k{i}", i, "n") for i in range(200)]
    source = table(spark, *same, ("gone", 1, "n"), ("amount", 1, "n"), ("null", None, "n"), ("swap", None, "5"), ("twice", 1, "a"), ("twice", 1, "a"), (None, 1, "x"))
    target = table(spark, *same, ("new", 1, "n"), ("amount", 2, "m"), ("null", 0, "n"), ("swap", 5, None), ("twice", 1, "a"), (None, 1, "x"))
    report = rec.reconcile_keys(source, target, ["id"], COLUMNS)
    assert found(report) == {
        "gone": ("missing", ""), "new": ("extra", ""), "amount": ("differing", "amount,note"), "null": ("differing", "amount"),
        "swap": ("differing", "amount,note"), "twice": ("differing", ""),
    }
    assert len(report.unequal_buckets) <= 6 and report.unequal_fine <= 6


def test_equal_tables_in_any_order(spark):
    rows = [(f"k{i}", i % 3, None) for i in range(500)]
    report = rec.reconcile_keys(table(spark, *rows).repartition(7), table(spark, *rows[::-1]), ["id"], COLUMNS)
    assert found(report) == {} and report.unequal_buckets == []
    empty = table(spark, *rows).limit(0)
    assert found(rec.reconcile_keys(empty, empty, ["id"], COLUMNS)) == {}
    assert set(found(rec.reconcile_keys(table(spark, ("a", 1, "x")), empty, ["id"], COLUMNS)).values()) == {("missing", "")}


def test_equal_copies_do_not_cancel(spark):
    """Two equal rows more on one side leave the exclusive or as it is."""
    source, target = table(spark, ("a", 1, "x"), ("a", 1, "x"), ("a", 1, "x")), table(spark, ("a", 1, "x"))
    assert found(rec.reconcile_keys(source, target, ["id"], COLUMNS)) == {"a": ("differing", "")}


def test_only_unequal_buckets_are_read_again(spark):
    rows = [(f"k{i}", i, "n") for i in range(400)]
    paths = []
    for data in (rows, [(k, a + (k == "k7"), n) for k, a, n in rows]):
        path = fresh_path(spark, "bucketed")
        table(spark, *data).withColumn("b", rec.key_bucket(["id"], 16)).write.partitionBy("b").parquet(path)
        paths.append(path)
    tables = [spark.read.schema("id string, amount int, note string, b int").parquet(p) for p in paths]
    report = rec.reconcile_keys(*tables, ["id"], COLUMNS, stored_bucket="b", buckets=16)
    assert found(report) == {"k7": ("differing", "amount")} and len(report.unequal_buckets) == 1
    plan = explained(report.keys)
    filters = [line for line in plan.splitlines() if line.startswith("PartitionFilters")]
    assert len(filters) == 2 and all(f"b#" in line and str(report.unequal_buckets[0]) in line for line in filters)


def test_hot_key(spark):
    """A third of the rows share a key: one row a task reaches the shuffle, and the answer is right."""
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"), F.col("id").cast("int").alias("amount"), F.lit("n").alias("note"))
    other = rows.withColumn("amount", F.when(F.col("amount") == 3000, -1).otherwise(F.col("amount")))
    assert found(rec.reconcile_keys(rows, other, ["id"], COLUMNS)) == {"hot": ("differing", "")}


# --- the ledger


def load(spark, path, source, **options):
    extract = extract_by_ledger(spark, source, path, ["id"], buckets=4)
    batch = sorted(map(tuple, extract.batch.collect()), key=str)
    return batch, extract


def test_changes_without_a_new_time(spark):
    path = fresh_path(spark, "ledger")
    first = table(spark, ("a", 1, "x"), ("b", 2, None))
    batch, extract = load(spark, path, first)
    assert batch == [("a", 1, "x"), ("b", 2, None)]
    assert load(spark, path, first)[0] == batch  # not stored yet: a stopped load reads the same batch
    store_ledger(spark, path, extract, ["id"], buckets=4)
    assert load(spark, path, first)[0] == []
    second = table(spark, ("a", 1, None), ("b", 2, None), ("late", 0, "x"))
    batch, extract = load(spark, path, second)
    assert batch == [("a", 1, None), ("late", 0, "x")] and extract.gone.isEmpty()
    touched = store_ledger(spark, path, extract, ["id"], buckets=4)
    assert len(touched) <= 2 and load(spark, path, second)[0] == []


def test_keys_that_left_the_source(spark):
    path = fresh_path(spark, "ledger")
    _, extract = load(spark, path, table(spark, ("a", 1, "x"), ("b", 2, "x"), ("c", 3, "x")))
    store_ledger(spark, path, extract, ["id"], buckets=4)
    batch, extract = load(spark, path, table(spark, ("a", 1, "x")))
    assert batch == [] and sorted(r.id for r in extract.gone.collect()) == ["b", "c"]
    store_ledger(spark, path, extract, ["id"], forget_gone=True, buckets=4)
    assert load(spark, path, table(spark, ("a", 1, "x"), ("b", 2, "x")))[0] == [("b", 2, "x")]


def test_repeated_and_missing_keys(spark):
    path = fresh_path(spark, "ledger")
    source = table(spark, ("a", 1, "x"), ("a", 2, "x"), (None, 3, "x"))
    batch, extract = load(spark, path, source)
    assert len(batch) == 3
    store_ledger(spark, path, extract, ["id"], buckets=4)
    again = load(spark, path, source)[0]
    assert (None, 3, "x") in again and len(again) == 2
    schema = ledger_schema(source.schema, ["id"])
    assert read_declared(spark, path, schema).count() == 1 and BUCKET in schema.names


def test_columns_that_count(spark):
    path = fresh_path(spark, "ledger")
    extract = extract_by_ledger(spark, table(spark, ("a", 1, "x")), path, ["id"], ["id", "amount"], buckets=4)
    store_ledger(spark, path, extract, ["id"], buckets=4)
    assert extract_by_ledger(spark, table(spark, ("a", 1, "other")), path, ["id"], ["id", "amount"], buckets=4).batch.isEmpty()


@pytest.mark.parametrize("name", ["reconcile_keys"])
def test_driver_holds_bucket_sums_only(spark, name):
    sums = rec.bucket_sums(spark.range(1000).select(F.col("id").cast("string").alias("id")), ["id"], rec.key_bucket(["id"], 8).alias("b"))
    assert sums.count() == 8
