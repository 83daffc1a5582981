"""A stored dimension whose current versions lie apart from its history.

The table is partitioned by the year its versions end in. Current versions end in the open year, a partition of
their own, so a run reads and rewrites that partition only; versions it closes are appended to the year of the
run. Closed years are never read by a load, however long the history is, and a lookup for a date skips the years
before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline.functions.scalars import OPEN_END, day
from oreline.operators.scd2 import scd2_as_of, scd2_delta
from oreline.scratch import written
from oreline.sources.layout import ByDate, write_partitioned
from oreline.sources.publish import in_partitions, publish_partitions, read_declared
from oreline.sources.schemas import conform

BY_END = ByDate("valid_to", unit="year")
#: The partition of current versions.
OPEN_YEAR = OPEN_END.replace(month=1, day=1)


def build_apart(dim: DataFrame, path: str, key: str, schema: StructType) -> None:
    """Write a dimension in this layout; ``schema`` is that of the dimension without the partition column."""
    write_partitioned(dim, path, BY_END, (key,), schema)


def current_versions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The current versions: one partition."""
    return in_partitions(read_declared(spark, path, schema), BY_END.partition_column, [OPEN_YEAR])


def stored_as_of(spark: SparkSession, path: str, schema: StructType, when, inclusive: bool = True) -> DataFrame:
    """Versions valid on a date, from the years that can hold one."""
    stored = read_declared(spark, path, schema).filter(F.col(BY_END.partition_column) >= F.trunc(day(when), "year"))
    return scd2_as_of(stored, when, inclusive)


def publish_apart(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    run_date,
    schema: StructType,
    mode: str = "plain",
    now=None,
) -> int:
    """One run: close and open versions; returns how many rows that made. ``schema`` has the partition column.

    Closed versions are appended first, those already there left out, and the current partition is replaced last
    from a written table, so a run that stops anywhere is repeated with the same result. A second change of a key
    on the date of its first is an error, as both versions would start on that date.
    """
    column = BY_END.partition_column
    stored = read_declared(spark, path, schema)
    current = in_partitions(stored, column, [OPEN_YEAR]).drop(column)
    twice = F.raise_error(F.lit("a second change on the date of the first")).cast("boolean")
    delta = scd2_delta(current, source, key, tracked, run_date, mode, now)
    delta = written(BY_END.assign(delta.filter(F.when(F.col("valid_to") < F.col("valid_from"), twice).otherwise(True))), "delta")
    rows = delta.count()
    if not rows:
        return 0
    kept = current.join(delta.select(key).distinct(), key, "left_anti")
    after = written(BY_END.assign(kept).unionByName(delta.filter("is_current")), "current")
    closing = F.col(column) == F.trunc(F.date_sub(day(run_date), 1), "year")
    fresh = delta.filter(~F.col("is_current")).join(stored.filter(closing).select("_scd_key"), "_scd_key", "left_anti")
    closed = conform(fresh, schema).hint("rebalance", column).sortWithinPartitions(column, key)
    closed.write.mode("append").partitionBy(column).parquet(path)
    publish_partitions(after, path, column, [OPEN_YEAR], (key,), schema)
    return rows
