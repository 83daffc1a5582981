"""Dimension changes that arrive late, out of order or twice for one date.

The truth is a log of changes: what a key was from a date on, and when that was recorded. Of several changes of a
key on one date the one recorded last counts, so the log, and with it the dimension, is the same in whatever order
changes arrive. A late change splits the version it falls in and restates the ones next to it; only versions that
really differ are rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType, TimestampType

from oreline.functions.scalars import OPEN_END, day, text
from oreline.scratch import written
from oreline.sources.layout import ByDate
from oreline.sources.publish import in_partitions, partition_values, publish_partitions, read_declared
from oreline.sources.schemas import conform

EFFECTIVE, RECORDED, BUCKET = "effective", "recorded_at", "bucket"
BUCKETS = 64


def log_schema(schema: StructType, key: str, tracked: Sequence[str]) -> StructType:
    """The change log of a dimension with this schema: one row for each key and date, by bucket of the key."""
    kept = [StructField(c, schema[c].dataType, c != key) for c in (key, *tracked)]
    return StructType([*kept, StructField(EFFECTIVE, DateType(), False), StructField(RECORDED, TimestampType()), StructField(BUCKET, IntegerType())])


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def latest_changes(changes: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Of the changes of a key on one date the one recorded last; equal times are decided by the values.

    Reduced in the map tasks first, so many copies of one change are not gathered.
    """
    last = F.max(F.struct(RECORDED, *tracked)).alias("_last")
    return changes.groupBy(key, EFFECTIVE).agg(last).select(key, EFFECTIVE, "_last.*")


def versions_of(log: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """The versions a log (one row for each key and date) amounts to.

    A change that leaves all attributes as they were begins no version. A key has at most one row for each calendar
    day, which bounds what a window sorts. ``_created_at`` is when a version's change was recorded, ``_updated_at``
    when the one that ended it was, if later.
    """
    by_key = Window.partitionBy(key).orderBy(EFFECTIVE)
    now, before = F.struct(*tracked), F.lag(F.struct(*tracked)).over(by_key)
    begins = log.withColumn("_begins", F.lag(F.lit(1)).over(by_key).isNull() | ~now.eqNullSafe(before)).filter("_begins")
    ended = F.lead(EFFECTIVE).over(by_key)
    closed_by = F.lead(RECORDED).over(by_key)
    return begins.select(
        F.concat(text(F.col(key)), F.lit("_"), text(F.col(EFFECTIVE))).alias("_scd_key"),
        key,
        *tracked,
        F.col(EFFECTIVE).alias("valid_from"),
        F.coalesce(F.date_sub(ended, 1), day(OPEN_END)).alias("valid_to"),
        ended.isNull().alias("is_current"),
        F.col(RECORDED).alias("_created_at"),
        F.greatest(F.col(RECORDED), closed_by).alias("_updated_at"),
    )


def changes_of(dim: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """The log that a dimension kept by daily runs amounts to: one change where each version begins."""
    return dim.select(key, *tracked, F.col("valid_from").alias(EFFECTIVE), F.col("_created_at").alias(RECORDED))


def seed_log(dim: DataFrame, path: str, key: str, tracked: Sequence[str], schema: StructType, buckets: int = BUCKETS) -> None:
    """Write the log of a dimension that has none yet."""
    log = latest_changes(changes_of(dim, key, tracked), key, tracked).withColumn(BUCKET, _bucket(key, buckets))
    content = conform(log, log_schema(schema, key, tracked))
    content.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, key).write.partitionBy(BUCKET).parquet(path)


def splice_changes(
    spark: SparkSession,
    dim_path: str,
    log_path: str,
    changes: DataFrame,
    key: str,
    tracked: Sequence[str],
    schema: StructType,
    layout: ByDate,
    buckets: int = BUCKETS,
) -> list:
    """Fold ``changes`` (key, tracked attributes, ``effective``, ``recorded_at``) into the stored log and dimension.

    Reads the log buckets of the keys that changed and the partitions of the dimension in which one of their
    versions differs afterwards; returns those. The dimension is published first and the log last: a run that
    stops in between finds the old log and does the same again. A change without key or date is an error.
    """
    column, kinds = layout.partition_column, log_schema(schema, key, tracked)
    bad = F.col(key).isNull() | F.col(EFFECTIVE).isNull()
    lost = F.raise_error(F.lit("a change without key or date")).cast("boolean")
    known_good = changes.filter(F.when(bad, lost).otherwise(True))
    batch = written(latest_changes(known_good, key, tracked).withColumn(BUCKET, _bucket(key, buckets)), "changes")
    reached = partition_values(batch, BUCKET)
    if not reached:
        return []
    log = in_partitions(read_declared(spark, log_path, kinds), BUCKET, reached)
    keys = batch.select(key).distinct()
    held = written(log.join(keys, key, "left_semi"), "held-changes")
    merged = latest_changes(held.unionByName(batch), key, tracked).withColumn(BUCKET, _bucket(key, buckets))

    old = layout.assign(versions_of(held, key, tracked))
    new = layout.assign(versions_of(merged, key, tracked))
    values = [c for c in old.columns if c not in (key, "valid_from")]
    pairs = old.select(key, "valid_from", F.struct(*values).alias("_old")).join(
        new.select(key, "valid_from", F.struct(*values).alias("_new")), [key, "valid_from"], "full"
    )
    differing = written(pairs.filter(~F.col("_old").eqNullSafe(F.col("_new"))), "spliced")
    years = partition_values(layout.assign(differing), column)
    if years:
        stored = in_partitions(read_declared(spark, dim_path, schema), column, years)
        rest = stored.join(differing.select(key, "valid_from"), [key, "valid_from"], "left_anti")
        fresh = differing.filter(F.col("_new").isNotNull()).select(key, "valid_from", "_new.*")
        content = rest.select(*schema.names).unionByName(fresh.select(*schema.names))
        publish_partitions(written(conform(content, schema), "spliced-dim"), dim_path, column, years, (key, "is_current"), schema)
    others = log.join(batch.select(key, EFFECTIVE), [key, EFFECTIVE], "left_anti")
    winners = merged.join(batch.select(key, EFFECTIVE), [key, EFFECTIVE], "left_semi")
    content = conform(others, kinds).unionByName(conform(winners, kinds))
    publish_partitions(written(content, "spliced-log"), log_path, BUCKET, reached, (key,), kinds)
    return sorted(years, key=str)
