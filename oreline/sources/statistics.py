"""Table statistics that merge: one row for each partition and column, kept beside a table.

A load recomputes the rows of the partitions it touched; every question about the whole table, or about any of
its partitions, is answered from the stored rows alone. Counts and sizes add up, bounds take the least and the
greatest, and distinct values and quantiles merge as sketches: a HyperLogLog state and a KLL state of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from oreline.scratch import written
from oreline.sources.layout import estimate_scan, logical_bytes
from oreline.sources.publish import in_partitions, publish_partitions, read_declared

#: Registers of a distinct sketch (2 ** LG_K): 1.6 % standard error, about 4 KB.
LG_K = 12
#: Size of a quantile sketch: a rank is off by about 1.3 % at most, and the sketch has a few KB.
KLL_K = 200

STATISTICS = StructType(
    [
        StructField("partition_id", StringType(), False),
        StructField("column_name", StringType(), False),
        StructField("total_rows", LongType()),
        StructField("nulls", LongType()),
        StructField("total_bytes", LongType()),
        StructField("least", StringType()),
        StructField("greatest", StringType()),
        StructField("least_number", DoubleType()),
        StructField("greatest_number", DoubleType()),
        StructField("distinct_state", BinaryType()),
        StructField("quantile_state", BinaryType()),
    ]
)
PARTITION = "partition_id"
#: Id of the partition of rows without a partition value. The folder name such a partition has cannot be a value.
NO_PARTITION = "__none__"


def _number(df: DataFrame, column: str) -> Column | None:
    """The value as a double, for types with an order that a double keeps: dates as days, times as seconds."""
    kind = dict(df.dtypes)[column]
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.col(column).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind == "timestamp":
        return F.col(column).cast("double")
    return None


def _sketchable(df: DataFrame, column: str) -> Column:
    """The value in a type the distinct sketch takes."""
    kind = dict(df.dtypes)[column]
    return F.col(column) if kind in ("int", "bigint", "string", "binary") else F.col(column).cast("string")


def collect_statistics(df: DataFrame, partition_column: str, columns: Sequence[str]) -> DataFrame:
    """Statistics of ``df`` by partition and column, from one scan of ``columns``.

    All states are aggregates with a partial step in the map tasks, so a partition with most of the rows is no
    more than one row a task when it is shuffled.
    """
    aggregates = [F.count("*").alias("rows")]
    for c in columns:
        number = _number(df, c)
        nothing = F.lit(None).cast("double")
        aggregates += [
            F.count(c).alias(f"{c}.known"),
            F.sum(logical_bytes(df, c)).alias(f"{c}.bytes"),
            F.min(F.col(c)).cast("string").alias(f"{c}.least"),
            F.max(F.col(c)).cast("string").alias(f"{c}.greatest"),
            (nothing if number is None else F.min(number)).alias(f"{c}.low"),
            (nothing if number is None else F.max(number)).alias(f"{c}.high"),
            F.hll_sketch_agg(_sketchable(df, c), LG_K).alias(f"{c}.distinct"),
            (F.lit(None).cast("binary") if number is None else F.kll_sketch_agg_double(number, KLL_K)).alias(f"{c}.quantiles"),
        ]
    partition = F.coalesce(F.col(partition_column).cast("string"), F.lit(NO_PARTITION)).alias(PARTITION)
    wide = df.withColumn(PARTITION, partition).groupBy(PARTITION).agg(*aggregates)
    of = lambda c, name: F.col(f"`{c}.{name}`")
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows").alias("total_rows"),
            (F.col("rows") - of(c, "known")).alias("nulls"),
            of(c, "bytes").alias("total_bytes"),
            of(c, "least").alias("least"),
            of(c, "greatest").alias("greatest"),
            of(c, "low").alias("least_number"),
            of(c, "high").alias("greatest_number"),
            of(c, "distinct").alias("distinct_state"),
            of(c, "quantiles").alias("quantile_state"),
        )
        for c in columns
    ]
    return wide.select(PARTITION, F.inline(F.array(*rows)))


def refresh_statistics(
    spark: SparkSession,
    path: str,
    table_path: str,
    schema: StructType,
    partition_column: str,
    columns: Sequence[str],
    touched: Iterable | None = None,
) -> None:
    """Bring the statistics stored at ``path`` up to date with the partitions ``touched`` by a load (all: None).

    Only those partitions of the table are read and only theirs are replaced; a partition that is gone loses its
    rows. A run that stops can be repeated.
    """
    table = read_declared(spark, table_path, schema)
    if touched is None:
        before = {r[0] for r in read_declared(spark, path, STATISTICS).select(PARTITION).distinct().collect()}
        fresh = written(collect_statistics(table, partition_column, columns), "statistics")
        names = before | {r[0] for r in fresh.select(PARTITION).distinct().collect()}
    else:
        touched = list(touched)
        names = {NO_PARTITION if v is None else str(v) for v in touched}
        fresh = written(collect_statistics(in_partitions(table, partition_column, touched), partition_column, columns), "statistics")
    publish_partitions(fresh, path, PARTITION, names, schema=STATISTICS)


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    return read_declared(spark, path, STATISTICS)


def table_statistics(statistics: DataFrame, predicate: Column | str | None = None) -> DataFrame:
    """One row for each column over the partitions ``predicate`` selects, from stored rows only.

    ``distinct_values`` and the quartiles are estimates; the rest is exact. Least and greatest texts of numbers,
    dates and times are picked by their number.
    """
    picked = statistics if predicate is None else statistics.filter(predicate)
    first = F.min(F.when(F.col("least_number").isNull(), F.col("least")))
    last = F.max(F.when(F.col("greatest_number").isNull(), F.col("greatest")))
    merged = picked.groupBy("column_name").agg(
        F.count("*").alias("partitions"),
        F.sum("total_rows").alias("total_rows"),
        F.sum("nulls").alias("nulls"),
        F.sum("total_bytes").alias("total_bytes"),
        F.coalesce(F.min_by("least", "least_number"), first).alias("least"),
        F.coalesce(F.max_by("greatest", "greatest_number"), last).alias("greatest"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_state")).alias("distinct_values"),
        F.kll_merge_agg_double("quantile_state").alias("_quantiles"),
    )
    quartiles = F.kll_sketch_get_quantile_double("_quantiles", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    some = F.col("_quantiles").isNotNull() & (F.col("total_rows") > F.col("nulls"))
    return merged.withColumn("quartiles", F.when(some & (F.kll_sketch_get_n_double("_quantiles") > 0), quartiles)).drop("_quantiles")


def scan_cost_from_statistics(
    statistics: DataFrame, columns: Sequence[str], predicate: Column | str | None = None, price_per_tb: float = 5.0
) -> DataFrame:
    """Bytes and price of reading ``columns`` of the partitions ``predicate`` selects, without touching the table."""
    sizes = statistics.filter(F.col("column_name").isin(*columns)).groupBy(PARTITION).agg(F.sum("total_bytes").alias("total_bytes"))
    return estimate_scan(sizes, predicate, price_per_tb)


def profile_from_statistics(statistics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Estimated distinct values per column, from stored rows."""
    return table_statistics(statistics.filter(F.col("column_name").isin(*columns))).select("column_name", "distinct_values")


def advice_from_statistics(statistics: DataFrame, columns: Sequence[str], max_cols: int = 4, max_ratio: float = 0.5) -> DataFrame:
    """Which columns to sort files by, coarsest first, judged by stored distinct sketches."""
    profile = table_statistics(statistics.filter(F.col("column_name").isin(*columns)))
    ratio = F.try_divide(F.col("distinct_values").cast("double"), F.col("total_rows").cast("double"))
    picked = profile.filter(ratio <= max_ratio).orderBy("distinct_values", "column_name").limit(max_cols)
    return picked.select("column_name", "distinct_values", F.round(ratio, 6).alias("distinct_ratio"))


def partitions_from_statistics(statistics: DataFrame, limit: int = 30) -> DataFrame:
    """The newest ``limit`` partitions with their rows and logical bytes of all recorded columns."""
    by_partition = statistics.groupBy(PARTITION).agg(F.max("total_rows").alias("total_rows"), F.sum("total_bytes").alias("total_bytes"))
    dated = F.when(F.col(PARTITION) != NO_PARTITION, F.col(PARTITION))
    return by_partition.withColumn(PARTITION, dated).orderBy(F.desc_nulls_last(PARTITION)).limit(limit)
