"""Clustering over files: rows near each other in several columns at once lie in the same file.

Rows are ordered along a Hilbert curve through the quantile ranks of up to four columns, and files are cut along
it, so the least and greatest value of each clustered column span a small part of its range in every file and a
filter on any one of them skips most files. The cuts between ranks are stored beside the table: later loads use
the same key, and upkeep can tell from files' key intervals where they overlap.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline.scratch import written
from oreline.sources.files import NULL_PARTITION, data_files, delete_dir, exists, move, plain_path, read_text, write_text
from oreline.sources.layout import MAX_SORT_COLUMNS, Layout
from oreline.sources.schemas import conform

#: Bits of a column's rank: 64 ranks. With four columns the key has 24 bits, far more cells than a partition has files.
BITS = 6
#: Rows the cuts are fitted on at most.
SAMPLE_ROWS = 20_000
CUTS_FILE = "_clustering.json"
JOURNAL = "_reclustering.json"
#: Files moved or removed at a time.
FILE_CALLS = 16
#: Key of a row in a table being written or inspected.
KEY = "_cluster_key"


@dataclass(frozen=True)
class Curve:
    """The clustered columns, most selective filters first or in any order, and the values that part their ranks."""

    columns: tuple[str, ...]
    cuts: tuple[tuple, ...]
    bits: int = BITS

    def rank(self, position: int) -> Column:
        """How many cuts of the column are at or below its value; a missing value is below all of them."""
        value, cuts = F.col(self.columns[position]), self.cuts[position]

        def search(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            return F.when(value < F.lit(cuts[middle]), search(low, middle)).otherwise(search(middle + 1, high))

        return F.when(value.isNull(), F.lit(0)).otherwise(search(0, len(cuts)))

    def keyed(self, df: DataFrame) -> DataFrame:
        """``df`` with the place of each row's cell on a Hilbert curve through all cells.

        Cells that follow each other on the curve are neighbours, so a file, which is a run of it, is compact.
        """
        bits = self.bits

        @F.pandas_udf("bigint")
        def place(*ranks: pd.Series) -> pd.Series:
            return pd.Series(hilbert_key([r.to_numpy(np.int64) for r in ranks], bits))

        return df.withColumn(KEY, place(*[self.rank(i) for i in range(len(self.columns))]))


def hilbert_key(ranks: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Places on the curve of many cells at once, each given by one rank of ``bits`` bits for every axis.

    The ranks are turned and mirrored from the highest bit down, Gray coded, and their bits interleaved (Skilling's
    form of the curve).
    """
    x, count = list(ranks), len(ranks)
    for q in (1 << bit for bit in range(bits - 1, 0, -1)):
        low = q - 1
        for axis in range(count):
            # Below the bit, the first axis is mirrored or changes places with the step's axis.
            mirrored = (x[axis] & q) != 0
            moved = np.where(mirrored, 0, (x[0] ^ x[axis]) & low)
            x[0] = x[0] ^ np.where(mirrored, low, moved)
            if axis:
                x[axis] = x[axis] ^ moved
    for axis in range(1, count):
        x[axis] = x[axis] ^ x[axis - 1]
    flips = np.zeros_like(x[0])
    for q in (1 << bit for bit in range(bits - 1, 0, -1)):
        flips ^= np.where((x[-1] & q) != 0, q - 1, 0)
    key = np.zeros_like(x[0])
    for axis in range(count):
        for bit in range(bits):
            key |= (((x[axis] ^ flips) >> bit) & 1) << (bit * count + count - 1 - axis)
    return key


def fit_curve(df: DataFrame, columns: Sequence[str], bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> Curve:
    """Cuts at equal shares of a bounded sample of rows, for each column.

    The sample is a hash of all columns below a bound, so the driver holds ``sample_rows`` rows at most. A value
    that fills several ranks gets one: columns with few values use fewer cuts.
    """
    if not 1 <= len(columns) <= MAX_SORT_COLUMNS:
        raise ValueError(f"one to {MAX_SORT_COLUMNS} columns")
    rows = df.count()
    picked = df.where(F.pmod(F.xxhash64(*df.columns), F.lit(max(1, rows))) < sample_rows).select(*columns).limit(sample_rows).collect()
    cuts = []
    for column in columns:
        values = sorted(_zoned(r[column]) for r in picked if r[column] is not None)
        parts = 1 << bits
        found = {values[len(values) * i // parts] for i in range(1, parts)} if values else set()
        cuts.append(tuple(sorted(found - {values[0]} if values else found)))
    return Curve(tuple(columns), tuple(cuts), bits)


def _zoned(value):
    """Times with their zone, so that a cut means the same on every machine."""
    return value.astimezone(dt.UTC) if isinstance(value, dt.datetime) else value


def _plain(value):
    """A cut as JSON can hold it, with its kind."""
    if isinstance(value, dt.datetime):
        return ["timestamp", value.isoformat(sep=" ")]
    if isinstance(value, dt.date):
        return ["date", value.isoformat()]
    if isinstance(value, Decimal):
        return ["decimal", str(value)]
    return ["value", value]


def _parsed(kind: str, value):
    kinds = {"timestamp": dt.datetime.fromisoformat, "date": dt.date.fromisoformat, "decimal": Decimal, "value": lambda v: v}
    return kinds[kind](value)


def store_curve(spark: SparkSession, path: str, curve: Curve) -> None:
    """Keep the curve beside the table's files; names that begin with ``_`` are not read as data."""
    content = {"columns": curve.columns, "bits": curve.bits, "cuts": [[_plain(v) for v in cuts] for cuts in curve.cuts]}
    write_text(spark, f"{path}/{CUTS_FILE}", json.dumps(content))


def read_curve(spark: SparkSession, path: str) -> Curve:
    content = json.loads(read_text(spark, f"{path}/{CUTS_FILE}"))
    return Curve(tuple(content["columns"]), tuple(tuple(_parsed(*v) for v in cuts) for cuts in content["cuts"]), content["bits"])


def _in_files(placed: DataFrame, curve: Curve, column: str, files: int) -> DataFrame:
    """Rows in ``files`` ranges of partition and key; a hash cuts a cell of equal keys over several."""
    salted = curve.keyed(placed).withColumn("_salt", F.xxhash64(*placed.columns))
    ranged = salted.repartitionByRange(files, column, KEY, "_salt").sortWithinPartitions(column, KEY, *curve.columns)
    return ranged.drop(KEY, "_salt")


def write_clustered(
    df: DataFrame,
    path: str,
    layout: Layout,
    columns: Sequence[str],
    rows_per_file: int,
    schema: StructType | None = None,
    row_group_bytes: int = 0,
) -> Curve:
    """Write a partitioned table whose files are cut along the curve of ``columns``.

    The first load fits the cuts and stores them; a later load appends its rows along the same curve, in files
    of its own, which ``recluster`` merges with those they overlap. The rows are computed once and written, for
    they are counted, sampled for cuts and for file bounds, and sorted.
    """
    spark = df.sparkSession
    if schema is not None:
        df = conform(df, schema)
    rows = written(layout.assign(df), "clustered")
    if exists(spark, f"{path}/{CUTS_FILE}"):
        curve = read_curve(spark, path)
    else:
        curve = fit_curve(rows.select(df.columns), columns)
        store_curve(spark, path, curve)
    if curve.columns != tuple(columns):
        raise ValueError(f"the table is clustered by {curve.columns}")
    column = layout.partition_column
    files = max(1, -(-rows.count() // rows_per_file))
    writer = _in_files(rows, curve, column, files).write.partitionBy(column).mode("append")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    return curve


# --- upkeep


def file_intervals(table: DataFrame, curve: Curve, partition_column: str) -> DataFrame:
    """``partition, file, rows, low, high``: the key interval of each file of a table read from files.

    Reads the clustered columns only; each task reduces its files before anything is shuffled. A missing
    partition value has the name of its folder.
    """
    partition = F.coalesce(F.col(partition_column).cast("string"), F.lit(NULL_PARTITION)).alias("partition")
    keyed = curve.keyed(table.select(partition, *curve.columns, F.col("_metadata.file_path").alias("file")))
    return keyed.groupBy("partition", "file").agg(F.count("*").alias("rows"), F.min(KEY).alias("low"), F.max(KEY).alias("high"))


def overlaps(intervals: DataFrame, max_depth: int) -> DataFrame:
    """``intervals`` with ``depth``, the files open where the file begins, and ``deep``: whether more than
    ``max_depth`` files of its partition lie on one key somewhere in its interval.

    A sweep over interval ends. Files are open that begin at or before a point and do not end before it; the
    most are open at some end inside an interval, so counting ends with too many of them answers for all
    intervals at once. Rows here are files, not data, and no file is compared with another.
    """
    ends = F.array(F.struct(F.col("low").alias("at"), F.lit(1).alias("opens"), F.lit(0).alias("closes")), F.struct(F.col("high").alias("at"), F.lit(0).alias("opens"), F.lit(1).alias("closes")))
    points = intervals.select("partition", F.inline(ends)).groupBy("partition", "at").agg(F.sum("opens").alias("opens"), F.sum("closes").alias("closes"))
    sweep = Window.partitionBy("partition").orderBy("at")
    upto, before = sweep.rowsBetween(Window.unboundedPreceding, 0), sweep.rowsBetween(Window.unboundedPreceding, -1)
    open_ = points.withColumn("open", F.sum("opens").over(upto) - F.coalesce(F.sum("closes").over(before), F.lit(0)))
    many = (F.col("open") > max_depth).cast("int")
    counted = open_.withColumn("many", many).withColumns({"through": F.sum("many").over(upto), "until": F.coalesce(F.sum("many").over(before), F.lit(0))})
    start = counted.select("partition", F.col("at").alias("low"), F.col("open").alias("depth"), "until")
    end = counted.select("partition", F.col("at").alias("high"), "through")
    judged = intervals.join(start, ["partition", "low"]).join(end, ["partition", "high"])
    return judged.select(*intervals.columns, "depth", (F.col("through") > F.col("until")).alias("deep"))


@dataclass(frozen=True)
class Reclustered:
    """Paths of the files replaced and of those written in their place."""

    removed: list[str]
    added: list[str]


def recluster(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partition_column: str,
    rows_per_file: int,
    max_depth: int = 2,
    within: Column | str | None = None,
) -> Reclustered:
    """Rewrite the files that overlap more than ``max_depth`` deep, and only those, along the table's curve.

    ``schema`` is that of the stored table, its partition column included; ``within`` bounds the partitions looked
    at. New files are written into a hidden folder of the table. A journal then names them and the files they
    replace, and from there the step only moves on: new files into place, old ones away, journal last. Stopped
    anywhere, it is made whole by ``finish_reclustering``, which the next run calls first. A reader in that
    moment can see rows twice and never misses one.
    """
    finish_reclustering(spark, path)
    curve = read_curve(spark, path)
    table = spark.read.schema(schema).parquet(path)
    looked = table if within is None else table.filter(within)
    intervals = written(file_intervals(looked, curve, partition_column), "intervals")  # read three times
    old = overlaps(intervals, max_depth).filter("deep").select("file", "rows").collect()
    if not old:
        return Reclustered([], [])
    names = [plain_path(spark, r.file) for r in old]
    source = spark.read.schema(schema).option("basePath", path).parquet(*names)
    staged = f"{path}/_reclustered-{uuid.uuid4().hex}"
    files = max(1, -(-sum(r.rows for r in old) // rows_per_file))
    _in_files(source, curve, partition_column, files).write.partitionBy(partition_column).parquet(staged)
    write_text(spark, f"{path}/{JOURNAL}", json.dumps({"staged": staged, "new": data_files(spark, staged), "old": names}))
    return finish_reclustering(spark, path)


def finish_reclustering(spark: SparkSession, path: str) -> Reclustered:
    """Carry out what the journal says, as far as it is not done yet."""
    journal = f"{path}/{JOURNAL}"
    if not exists(spark, journal):
        return Reclustered([], [])
    step = json.loads(read_text(spark, journal))
    waiting = set(data_files(spark, step["staged"]))
    # Calls to the file system, one for each file: many at a time, old files after all new ones are in place.
    with ThreadPoolExecutor(FILE_CALLS) as pool:
        list(pool.map(lambda name: move(spark, f"{step['staged']}/{name}", f"{path}/{name}"), [n for n in step["new"] if n in waiting]))
        list(pool.map(lambda name: delete_dir(spark, name), step["old"]))
    delete_dir(spark, step["staged"])
    delete_dir(spark, journal)
    spark.catalog.refreshByPath(path)
    return Reclustered(step["old"], [f"{path}/{name}" for name in step["new"]])
