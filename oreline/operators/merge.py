"""Upsert a batch into a table by key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline.scratch import written
from oreline.sources.publish import in_partitions, partition_values, publish_partitions, read_declared


@dataclass(frozen=True)
class Batch:
    """A written batch with unique keys and its number of rows."""

    table: DataFrame
    rows: int


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _latest(batch: DataFrame, keys: Sequence[str], has_key: Column, latest_by: str) -> DataFrame:
    """The row of each key with the greatest ``latest_by``; equal times are decided by the other columns.

    Rows of a key are reduced in the map tasks, so a key with many copies is not gathered in
    one place. Rows without a key stay as they are: a number of their own tells them apart, so
    one pass over the batch serves both.
    """
    rest = sorted((c for c in batch.columns if c not in keys), key=lambda c: c != latest_by)
    own = F.when(~has_key, F.monotonically_increasing_id())
    single = batch.withColumn("_own", own).groupBy(*keys, "_own").agg(F.max(F.struct(*rest)).alias("_row"))
    return single.select(*keys, "_row.*").select(*batch.columns)


def unique_batch(
    batch: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    on_null_key: str = "error",
    latest_by: str = "updated_at",
) -> Batch:
    """The batch as a written table with one row per key.

    A repeated key is an error, or its latest row is kept. A NULL key equals no key, so such a
    row would be inserted again by every replay; it is an error unless ``on_null_key`` is
    ``"insert"``. The batch is computed once, and its files tell Spark how large it is.
    """
    if on_duplicate not in ("error", "latest") or on_null_key not in ("error", "insert"):
        raise ValueError("on_duplicate: error or latest; on_null_key: error or insert")
    has_key = _all(F.col(k).isNotNull() for k in keys)
    if on_duplicate == "latest":
        batch = _latest(batch, keys, has_key, latest_by)
    table = written(batch, "batch")
    found = (
        table.groupBy(*keys)
        .count()
        .agg(
            F.max(F.when(has_key, F.col("count"))).alias("copies"),
            F.sum(F.when(~has_key, F.col("count"))).alias("keyless"),
            F.sum("count").alias("rows"),
        )
        .first()
    )
    if on_null_key == "error" and found.keyless:
        raise ValueError(f"the batch has {found.keyless} rows without a key")
    if (found.copies or 0) > 1:
        raise ValueError(f"the batch has {found.copies} rows with one key")
    return Batch(table, found.rows or 0)


def _prepared(
    batch: DataFrame | Batch, keys: Sequence[str], on_duplicate: str, on_null_key: str, only_if_newer: str | None
) -> Batch:
    if isinstance(batch, Batch):
        return batch
    return unique_batch(batch, keys, on_duplicate, on_null_key, only_if_newer or "updated_at")


def keys_held(table: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of ``table`` that ``batch`` has as well, each once.

    Keys of the table are made unique in the map tasks first, so that a key many rows share is
    not gathered. The batch is a written table, so Spark knows its size and picks the join.
    """
    return table.select(*keys).distinct().join(batch.select(*keys), list(keys), "left_semi")


def merge_upsert(
    target: DataFrame,
    batch: DataFrame | Batch,
    keys: Sequence[str],
    on_duplicate: str = "error",
    on_null_key: str = "error",
    only_if_newer: str | None = None,
    stamps: dict[str, Column] | None = None,
) -> DataFrame:
    """The table after the upsert, as a plan over ``target`` and the written batch.

    A matched row takes the batch's columns and the ``stamps``; columns only the target has
    stay as they are, and are NULL in an inserted row. With ``only_if_newer`` a matched row
    changes only if the batch row is later by that column. A batch already prepared by
    ``unique_batch`` is used as it is.
    """
    unique = _prepared(batch, keys, on_duplicate, on_null_key, only_if_newer)
    return _merged(target, unique, keys, keys_held(target, unique.table, keys), only_if_newer, stamps or {})


def _merged(
    target: DataFrame,
    unique: Batch,
    keys: Sequence[str],
    found: DataFrame,
    only_if_newer: str | None,
    stamps: dict[str, Column],
) -> DataFrame:
    """Upsert of a batch with unique keys, of which the target has those in ``found``.

    The target is the left side of the outer join for its new state, the side Spark may split
    when one of its keys is hot.
    """
    batch = unique.table
    unknown = [c for c in (*batch.columns, *stamps) if c not in target.columns]
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")

    values = [c for c in batch.columns if c not in keys]
    incoming = batch.select(*keys, F.struct(*values).alias("_new"))
    take = F.col("_new").isNotNull()
    if only_if_newer:
        newer = F.col(f"_new.{only_if_newer}") > F.col(only_if_newer)
        take = take & (newer | F.col(only_if_newer).isNull())

    def after(column: str) -> Column:
        old = F.col(column)
        if column in values:
            return F.when(take, F.col(f"_new.{column}")).otherwise(old).alias(column)
        if column in stamps:
            return F.when(take, stamps[column]).otherwise(old).alias(column)
        return old

    updated = target.join(incoming, list(keys), "left").select(*[after(c) for c in target.columns])

    fresh = batch.join(found, list(keys), "left_anti").withColumns(stamps)
    inserted = fresh.select(
        *[
            (F.col(c) if c in fresh.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c)
            for c in target.columns
        ]
    )
    return updated.unionByName(inserted)


SIGN = "_sign"


@dataclass(frozen=True)
class Upserted:
    """What a stored upsert changed: partitions rewritten, values rows moved from or to, and, if asked for, its
    signed images: every old version of a changed row with ``_sign`` -1 and every new one with +1."""

    partitions: list
    moved: dict[str, DataFrame]
    images: DataFrame | None = None


def signed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Old and new versions as one table of signed rows."""
    return before.withColumn(SIGN, F.lit(-1)).unionByName(after.withColumn(SIGN, F.lit(1)))


def upsert_partitions(
    spark: SparkSession,
    path: str,
    partition_column: str,
    batch: DataFrame | Batch,
    keys: Sequence[str],
    schema: StructType,
    sort_by: tuple[str, ...] = (),
    within: Column | str | None = None,
    on_duplicate: str = "error",
    on_null_key: str = "error",
    only_if_newer: str | None = None,
    stamps: dict[str, Column] | None = None,
    report: Sequence[str] = (),
    images: Sequence[str] = (),
) -> Upserted:
    """Upsert into a partitioned Parquet table, rewriting only the partitions it touches.

    The table is read and written with the declared ``schema``, its NOT NULL columns included,
    and its files are sorted by ``sort_by``; the first load creates it. Touched are the
    partitions the batch writes to and those that hold the old version of one of its rows,
    found by one scan of keys, partition column and ``report``. ``within`` bounds that scan for
    callers who know which partitions can hold old versions. For each column of ``report`` the
    outcome has the values of old and new versions, each once (``moved``). With ``images`` it has these columns
    of both versions of every row the batch touches, as signed rows; that scan then reads whole old versions.
    """
    unique = _prepared(batch, keys, on_duplicate, on_null_key, only_if_newer)
    target = read_declared(spark, path, schema)
    wanted = target.columns if images else list(dict.fromkeys([*keys, partition_column, *report]))
    searched = target if within is None else target.filter(within)
    held = written(searched.select(*wanted).join(unique.table.select(*keys), list(keys), "left_semi"), "held")
    touched = set(partition_values(held, partition_column)) | set(partition_values(unique.table, partition_column))
    # Both tables are written and stay as they are: the values are computed when someone asks for them.
    moved = {c: held.select(c).union(unique.table.select(c)).distinct() for c in report}
    found = held.select(*keys).distinct()
    changes = None
    if images:
        after = _merged(held, unique, keys, found, only_if_newer, stamps or {})
        changes = written(signed(held.select(*images), after.select(*images)), "images")
    if touched:
        rewritten = in_partitions(target, partition_column, touched)
        merged = written(_merged(rewritten, unique, keys, found, only_if_newer, stamps or {}), "merged")
        publish_partitions(merged, path, partition_column, touched, sort_by, schema)
    return Upserted(sorted(touched, key=str), moved, changes)


def delete_partitions(
    spark: SparkSession,
    path: str,
    partition_column: str,
    gone: DataFrame,
    keys: Sequence[str],
    schema: StructType,
    sort_by: tuple[str, ...] = (),
    images: Sequence[str] = (),
) -> Upserted:
    """Remove the rows whose key is in ``gone``, rewriting only the partitions that hold one.

    Rows without a key are never removed. ``images`` are the removed rows' columns to report, with ``_sign`` -1.
    A removal that stops half-way is repeated with the same keys.
    """
    gone = written(gone.select(*keys).distinct(), "gone")
    target = read_declared(spark, path, schema)
    wanted = list(dict.fromkeys([*keys, partition_column, *images]))
    held = written(target.select(*wanted).join(gone, list(keys), "left_semi"), "held")
    touched = partition_values(held, partition_column)
    if touched:
        kept = in_partitions(target, partition_column, touched).join(gone, list(keys), "left_anti")
        publish_partitions(written(kept, "kept"), path, partition_column, touched, sort_by, schema)
    changes = held.select(*images).withColumn(SIGN, F.lit(-1)) if images else None
    return Upserted(sorted(touched, key=str), {}, changes)


def mark_deleted(
    target: DataFrame, snapshot: DataFrame, keys: Sequence[str], flag: str = "is_deleted"
) -> DataFrame:
    """Set ``flag`` on rows whose key a full snapshot of the source no longer has.

    Rows are never removed, and a row that comes back is unmarked. The snapshot's keys are
    written, so that the join reads both sides through plain shuffles, which is what Spark
    needs to split a hot key of the target.
    """
    present = written(snapshot.select(*keys).distinct(), "snapshot-keys").withColumn("_present", F.lit(True))
    return target.join(present, list(keys), "left").withColumn(flag, F.col("_present").isNull()).drop("_present")
