"""Partitioned and sorted table layouts: write, guarded read, expiry, partition report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline.functions.scalars import day, instant, size_gb
from oreline.plans.explain import partition_filters
from oreline.sources.files import NULL_PARTITION, delete_dir, partition_dirs
from oreline.sources.schemas import conform

MAX_SORT_COLUMNS = 4


class PartitionFilterRequired(ValueError):
    """A scan would read every partition."""


@dataclass(frozen=True)
class ByDate:
    """One partition per day of a DATE column, or per month for thin data."""

    column: str
    unit: str = "day"

    @property
    def partition_column(self) -> str:
        return self.column if self.unit == "day" else f"{self.column}_{self.unit}"

    def _unit_start(self, value: Column) -> Column:
        return F.trunc(value, self.unit)

    def assign(self, df: DataFrame) -> DataFrame:
        if self.unit == "day":
            return df
        return df.withColumn(self.partition_column, self._unit_start(F.col(self.column)))

    def between(self, lo, hi) -> Column:
        wanted = F.col(self.column).between(day(lo), day(hi))
        if self.unit == "day":
            return wanted
        units = F.col(self.partition_column).between(self._unit_start(day(lo)), self._unit_start(day(hi)))
        return units & wanted


@dataclass(frozen=True)
class ByTimestampDate:
    """One partition per day of a TIMESTAMP column, kept in a derived date column."""

    column: str
    partition_column: str = "event_date"

    def assign(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.partition_column, F.to_date(self.column))

    def between(self, lo, hi) -> Column:
        lo, hi = instant(lo), instant(hi)
        days = F.col(self.partition_column).between(F.to_date(lo), F.to_date(hi))
        return days & F.col(self.column).between(lo, hi)


@dataclass(frozen=True)
class ByLoadDate:
    """One partition per load; the load date is given, so a repeated load lands in the same place."""

    load_date: str | dt.date | None = None
    partition_column: str = "_partitiondate"

    def assign(self, df: DataFrame) -> DataFrame:
        if self.load_date is None:
            raise ValueError("writing needs a load date")
        return df.withColumn(self.partition_column, day(self.load_date))

    def between(self, lo, hi) -> Column:
        return F.col(self.partition_column).between(day(lo), day(hi))


@dataclass(frozen=True)
class ByIntRange:
    """Half-open integer buckets 1..n; 0 holds smaller values, n+1 larger ones, NULL its own."""

    column: str
    start: int = 0
    end: int = 10_000_000
    step: int = 500_000
    partition_column: str = "id_bucket"

    def bucket(self, value: Column) -> Column:
        count = (self.end - self.start) // self.step
        return F.width_bucket(value, F.lit(self.start), F.lit(self.start + count * self.step), F.lit(count))

    def assign(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.partition_column, self.bucket(F.col(self.column)).cast("int"))

    def between(self, lo: int, hi: int) -> Column:
        buckets = F.col(self.partition_column).between(
            self.bucket(F.lit(lo)).cast("int"), self.bucket(F.lit(hi)).cast("int")
        )
        return buckets & F.col(self.column).between(lo, hi)


Layout = ByDate | ByTimestampDate | ByLoadDate | ByIntRange


def write_partitioned(
    df: DataFrame,
    path: str,
    layout: Layout,
    sort_by: tuple[str, ...] = (),
    schema: StructType | None = None,
    mode: str = "errorifexists",
    dynamic: bool = False,
    max_records_per_file: int = 0,
    row_group_bytes: int = 0,
) -> None:
    """Write ``df`` under one directory per partition value, sorted inside by ``sort_by``.

    The rebalance shuffle groups each partition value, joins small ones into one task and
    splits a large one over many tasks by block, so a hot day, bucket or group of equal rows
    never lands in a single task, and no extra pass samples the input. Inside a file the rows
    are sorted, which is what row-group and page statistics need to skip; ``row_group_bytes``
    below the default makes the skipped units smaller.
    """
    if len(sort_by) > MAX_SORT_COLUMNS:
        raise ValueError(f"at most {MAX_SORT_COLUMNS} sort columns")
    if schema is not None:
        df = conform(df, schema)
    column = layout.partition_column
    placed = layout.assign(df).hint("rebalance", column).sortWithinPartitions(column, *sort_by)
    writer = placed.write.partitionBy(column).mode("overwrite" if dynamic else mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def require_partition_filter(df: DataFrame) -> DataFrame:
    """``df`` itself if each of its file scans is limited to some partitions.

    A not-null test alone does not count: it keeps every dated partition.
    """
    if not all(partition_filters(df)):
        raise PartitionFilterRequired("add a filter on the partition column")
    return df


def read_partitioned(
    spark: SparkSession,
    path: str,
    layout: Layout | None = None,
    predicate: Column | str | None = None,
    between: tuple | None = None,
    require: bool = True,
) -> DataFrame:
    """Scan a partitioned table; refuse a full scan unless ``require`` is off.

    ``between`` bounds the column the layout is built on and adds the matching bounds on the
    partition column.
    """
    df = spark.read.parquet(path)
    if between is not None:
        df = df.filter(layout.between(*between))
    if predicate is not None:
        df = df.filter(predicate)
    return require_partition_filter(df) if require else df


def unexpired(df: DataFrame, column: str, days: int, as_of: str | dt.date) -> DataFrame:
    """Rows a retention of ``days`` keeps at ``as_of``."""
    return df.filter(F.col(column) >= F.date_sub(day(as_of), days))


def expire_partitions(spark: SparkSession, path: str, layout: Layout, days: int, as_of: str | dt.date) -> list[str]:
    """Delete the date partitions of which every day is older than ``days``; returns their values.

    Works on directory names only: no data is read and nothing is rewritten. A month or year goes
    once its last day has expired; rows without a date stay.
    """
    if isinstance(layout, ByIntRange):
        raise ValueError("integer ranges do not expire: use a layout by date")
    unit = layout.unit if isinstance(layout, ByDate) else "day"
    oldest = dt.date.fromisoformat(str(as_of)) - dt.timedelta(days=days)
    dropped = []
    for value, directory in partition_dirs(spark, path, layout.partition_column).items():
        if value != NULL_PARTITION and _last_day(dt.date.fromisoformat(value), unit) < oldest:
            delete_dir(spark, directory)
            dropped.append(value)
    return sorted(dropped)


def _last_day(start: dt.date, unit: str) -> dt.date:
    if unit == "day":
        return start
    if unit == "week":
        return start + dt.timedelta(days=6)
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    after = start.month - 1 + months
    return dt.date(start.year + after // 12, after % 12 + 1, 1) - dt.timedelta(days=1)


def partition_sizes(df: DataFrame, partition_column: str) -> DataFrame:
    """Rows, bytes, files and last change of each partition of a table read from files.

    Only file footers are needed: no data column is selected. Rows of a file are counted in
    the map tasks before anything is shuffled.
    """
    files = (
        df.select(partition_column, "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        .groupBy(partition_column, "file_path")
        .agg(
            F.count("*").alias("rows"),
            F.max("file_size").alias("bytes"),
            F.max("file_modification_time").alias("modified"),
        )
    )
    return files.groupBy(partition_column).agg(
        F.sum("rows").alias("total_rows"),
        F.sum("bytes").alias("total_bytes"),
        F.count("*").alias("files"),
        F.max("modified").alias("last_modified_time"),
    )


def partition_stats(df: DataFrame, partition_column: str, limit: int = 30) -> DataFrame:
    """The newest ``limit`` partitions with row count, size and last change."""
    return (
        partition_sizes(df, partition_column)
        .select(
            F.col(partition_column).cast("string").alias("partition_id"),
            "total_rows",
            size_gb(F.col("total_bytes")).alias("size_gb"),
            "last_modified_time",
        )
        .orderBy(F.desc_nulls_last("partition_id"))
        .limit(limit)
    )


# Bytes a value counts for when a scan is priced; a text counts its UTF-8 bytes and two more, NULL nothing.
VALUE_BYTES = {"boolean": 1, "tinyint": 8, "smallint": 8, "int": 8, "bigint": 8, "float": 8, "double": 8, "date": 8}
VALUE_BYTES |= {"timestamp": 8, "timestamp_ntz": 8}
DECIMAL_BYTES = 16


def logical_bytes(df: DataFrame, column: str) -> Column:
    """Logical bytes of one value, whatever the files' encoding."""
    kind = df.schema[column].dataType.simpleString()
    if kind == "string":
        size = F.octet_length(column) + 2
    elif kind == "binary":
        size = F.octet_length(column)
    elif kind.startswith("decimal"):
        size = F.lit(DECIMAL_BYTES)
    elif kind in VALUE_BYTES:
        size = F.lit(VALUE_BYTES[kind])
    else:
        raise ValueError(f"no price for {column} {kind}")
    return F.when(F.col(column).isNull(), 0).otherwise(size).cast("bigint")


def logical_sizes(df: DataFrame, partition_column: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Logical bytes per partition of the columns a query reads."""
    total = sum((logical_bytes(df, c) for c in columns or df.columns), F.lit(0).cast("bigint"))
    return df.groupBy(partition_column).agg(F.sum(total).alias("total_bytes"))


BYTES_PER_TB = 10**12


def estimate_scan(sizes: DataFrame, predicate: Column | str | None = None, price_per_tb: float = 5.0) -> DataFrame:
    """Bytes and price of reading the partitions ``predicate`` selects."""
    picked = sizes if predicate is None else sizes.filter(predicate)
    scanned = F.coalesce(F.sum("total_bytes"), F.lit(0))
    return picked.agg(
        F.count("*").alias("partitions"),
        scanned.alias("bytes_scanned"),
        F.round(scanned / F.lit(BYTES_PER_TB) * F.lit(float(price_per_tb)), 6).alias("estimated_cost"),
    )
