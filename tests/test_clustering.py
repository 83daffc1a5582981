"""Files cut along a curve, and upkeep of those that overlap."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from oreline.plans.explain import explained
from oreline.scratch import fresh_path
from oreline.sources import clustering
from oreline.sources.clustering import Curve, file_intervals, finish_reclustering, fit_curve, overlaps, read_curve, recluster, store_curve, write_clustered
from oreline.sources.files import data_files, write_text
from oreline.sources.layout import ByDate
from tests.ddl import schema as ddl

DAY = ByDate("day")
COLUMNS = ("a", "b", "c")
SCHEMA = ddl("id bigint, a int, b decimal(10,2), c string, day date")


def rows(spark, first, last):
    """Three independent columns of three types."""
    mixed = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    return spark.range(first, last).select(
        "id",
        F.when(F.col("id") % 500 != 0, mixed(1, 5000)).cast("int").alias("a"),
        (mixed(2, 100000) / 100).cast("decimal(10,2)").alias("b"),
        F.lpad(mixed(3, 9000).cast("string"), 5, "0").alias("c"),
        F.lit("2024-01-01").cast("date").alias("day"),
    )


def bounds(spark, path):
    """Least and greatest value of each column in the footer of each file."""
    found = {}
    for name in data_files(spark, path):
        footer = pq.ParquetFile(f"{path}/{name}").metadata
        columns = {footer.schema.column(i).name: i for i in range(footer.num_columns)}
        stats = {c: [footer.row_group(g).column(columns[c]).statistics for g in range(footer.num_row_groups)] for c in COLUMNS}
        found[name] = {c: (min(s.min for s in found_), max(s.max for s in found_)) for c, found_ in stats.items()}
    return found


@pytest.fixture(scope="module")
def table(spark):
    path = fresh_path(spark, "curved")
    write_clustered(rows(spark, 0, 50_000), path, DAY, COLUMNS, 100)
    return path


def test_files_are_skipped_by_any_clustered_column(spark, table):
    files = bounds(spark, table)
    assert len(files) >= 480
    values = {"a": [17, 900, 2500, 4999], "b": [Decimal("3.14"), Decimal("500.00"), Decimal("999.99")], "c": ["00001", "04444", "08999"]}
    for column, asked in values.items():
        for value in asked:
            read = sum(low <= value <= high for low, high in (f[column] for f in files.values()))
            assert read <= 0.2 * len(files), (column, value, read, len(files))


def test_rows_and_order_survive(spark, table):
    assert spark.read.parquet(table).select(SCHEMA.names).exceptAll(rows(spark, 0, 50_000)).isEmpty()
    assert spark.read.parquet(table).count() == 50_000


def test_sorting_by_one_column_after_the_other_skips_less(spark, table):
    """What the curve is for: sorted by a, b, c a filter on the last column reads every file."""
    path = fresh_path(spark, "sorted")
    rows(spark, 0, 50_000).repartitionByRange(100, *COLUMNS).sortWithinPartitions(*COLUMNS).write.parquet(path)
    files = bounds(spark, path)
    assert sum(f["c"][0] <= "04444" <= f["c"][1] for f in files.values()) > 0.9 * len(files)


def test_hot_value_is_cut_into_files(spark):
    """A third of the rows are equal in all clustered columns."""
    path = fresh_path(spark, "hot")
    hot = rows(spark, 0, 6000).withColumns({c: F.when(F.col("id") % 3 == 0, F.lit(v)).otherwise(F.col(c)) for c, v in (("a", 7), ("c", "00007"))})
    hot = hot.withColumn("b", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("b")).cast("decimal(10,2)"))
    write_clustered(hot, path, DAY, COLUMNS, 250)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 4 * 250


def test_curve_is_kept_with_the_table(spark):
    path = fresh_path(spark, "curve")
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 6, tzinfo=dt.UTC)
    curve = Curve(("x", "y", "z", "t"), ((1, 2), (dt.date(2024, 1, 1),), ("é",), (at,)), 4)
    store_curve(spark, path, curve)
    assert read_curve(spark, path) == curve
    data = [(0, dt.date(2023, 1, 1), "a", dt.datetime(2000, 1, 1)), (2, dt.date(2024, 1, 1), "é", dt.datetime(2030, 1, 1)), (None, None, None, None)]
    keyed = curve.keyed(spark.createDataFrame(data, "x int, y date, z string, t timestamp"))
    ranks = [[r[0] for r in keyed.select(curve.rank(i)).collect()] for i in range(4)]
    assert ranks == [[0, 2, 0], [0, 1, 0], [0, 1, 0], [0, 1, 0]]


@pytest.mark.parametrize("axes,bits", [(1, 4), (2, 3), (3, 2), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours(spark, axes, bits):
    """The curve goes through every cell once, one step along one axis at a time."""
    side = 1 << bits
    names = "abcd"[:axes]
    curve = Curve(tuple(names), (tuple(range(1, side)),) * axes, bits)
    cells = [spark.range(side).select(F.col("id").cast("int").alias(n)) for n in names]
    df = cells[0]
    for more in cells[1:]:
        df = df.crossJoin(more)
    path = sorted((r[clustering.KEY], tuple(r[:axes])) for r in curve.keyed(df).collect())
    assert [k for k, _ in path] == list(range(side**axes))
    for (_, one), (_, two) in zip(path, path[1:]):
        assert sum(abs(x - y) for x, y in zip(one, two)) == 1


def test_fit_on_awkward_columns(spark):
    empty = fit_curve(spark.createDataFrame([], "x int, y string"), ["x", "y"])
    assert empty.cuts == ((), ())
    same = fit_curve(spark.range(100).select(F.lit(1).alias("x"), F.lit(None).cast("string").alias("y")), ["x", "y"])
    assert same.cuts == ((), ())
    with pytest.raises(ValueError):
        fit_curve(spark.range(3), [])


def test_overlap_depth(spark):
    files = [("p", "one", 1, 0, 9), ("p", "two", 1, 5, 6), ("p", "three", 1, 6, 20), ("p", "four", 1, 21, 30), ("q", "alone", 1, 0, 50)]
    df = spark.createDataFrame(files, "partition string, file string, rows bigint, low bigint, high bigint")
    found = {r.file: (r.depth, r.deep) for r in overlaps(df, 2).collect()}
    assert found == {"one": (1, True), "two": (2, True), "three": (3, True), "four": (1, False), "alone": (1, False)}
    assert not any(r.deep for r in overlaps(df, 3).collect())


def loaded(spark, small=10):
    path = fresh_path(spark, "upkeep")
    write_clustered(rows(spark, 0, 20_000), path, DAY, COLUMNS, 1000)
    for load in range(small):
        # Small loads of rows that all lie near each other.
        near = rows(spark, 20_000 + 100 * load, 20_100 + 100 * load).withColumns({"a": F.lit(5), "c": F.lit("00005")}).withColumn("b", F.lit(5).cast("decimal(10,2)"))
        write_clustered(near, path, DAY, COLUMNS, 1000)
    return path


def test_upkeep_touches_only_deep_files(spark):
    path = loaded(spark)
    before, content = set(data_files(spark, path)), spark.read.schema(SCHEMA).parquet(path).collect()
    done = recluster(spark, path, SCHEMA, "day", 1000)
    after = set(data_files(spark, path))
    removed = {name[name.index("day=") :] for name in done.removed}
    assert 10 <= len(removed) < len(before) / 2 + 5 and len(done.added) < len(removed)
    assert before - after == removed and before & after == before - removed
    assert sorted(map(tuple, spark.read.schema(SCHEMA).parquet(path).collect()), key=str) == sorted(map(tuple, content), key=str)
    intervals = file_intervals(spark.read.schema(SCHEMA).parquet(path), read_curve(spark, path), "day")
    assert overlaps(intervals, 2).filter("deep").count() <= 2
    assert "b#" not in explained(file_intervals(spark.read.schema(ddl("id bigint, a int, day date")).parquet(path), Curve(("a",), ((1,),)), "day"))


def test_upkeep_of_a_tidy_table_does_nothing(spark, table):
    before = data_files(spark, table)
    assert recluster(spark, table, SCHEMA, "day", 100, max_depth=4).added == [] and data_files(spark, table) == before


def test_stopped_upkeep_is_made_whole(spark, monkeypatch):
    """Stopped after one file was moved, and again before the first old one went."""
    path = loaded(spark, 4)
    content = sorted(map(tuple, spark.read.schema(SCHEMA).parquet(path).collect()), key=str)
    calls, real = [], clustering.move

    def stop(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("stopped")
        return real(*args)

    monkeypatch.setattr(clustering, "move", stop)
    with pytest.raises(OSError):
        recluster(spark, path, SCHEMA, "day", 200)
    monkeypatch.setattr(clustering, "move", real)
    monkeypatch.setattr(clustering, "delete_dir", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        finish_reclustering(spark, path)
    monkeypatch.undo()
    assert finish_reclustering(spark, path).removed
    assert finish_reclustering(spark, path).removed == []
    assert sorted(map(tuple, spark.read.schema(SCHEMA).parquet(path).collect()), key=str) == content
    assert not [n for n in data_files(spark, path) if "_reclustered" in n]


def test_upkeep_stopped_before_its_journal_leaves_the_table(spark):
    path = loaded(spark, 4)
    before = data_files(spark, path)
    rows(spark, 0, 10).write.partitionBy("day").parquet(f"{path}/_reclustered-lost")
    write_text(spark, f"{path}/_reclustering.json.part", "{")
    assert data_files(spark, path) == before or finish_reclustering(spark, path).removed == []
    assert spark.read.schema(SCHEMA).parquet(path).count() == 20_400


def test_keys_of_many_cells_at_once():
    """Every cell has a place of its own, and places that follow each other are neighbours."""
    for axes, bits in ((1, 3), (2, 3), (3, 2), (4, 2)):
        cells = np.indices((1 << bits,) * axes).reshape(axes, -1).astype(np.int64)
        keys = clustering.hilbert_key(list(cells), bits)
        assert sorted(keys) == list(range(1 << bits * axes))
        steps = np.abs(np.diff(cells[:, np.argsort(keys)], axis=1)).sum(axis=0)
        assert (steps == 1).all()


def test_rows_of_a_load_are_computed_once(spark):
    """The rows are counted, sampled and sorted from what is written, not from the query behind them."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    path = fresh_path(spark, "once")
    df = rows(spark, 0, 2000).mapInPandas(count, SCHEMA)
    write_clustered(df, path, DAY, COLUMNS, 500)
    assert seen.value == 2000 and spark.read.parquet(path).count() == 2000
