"""Slowly changing dimension, type 2: every version of a row with its validity dates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline.functions.scalars import OPEN_END, day, instant, text
from oreline.operators.merge import keys_held, unique_batch, upsert_partitions
from oreline.sources.layout import ByDate
from oreline.sources.publish import partition_values, read_declared


def _changed(tracked: Sequence[str], mode: str) -> Column:
    """Whether a tracked attribute differs from the incoming one.

    Plain inequality is not true when one side is NULL, so it misses changes to and from
    NULL; ``null_safe`` sees them.
    """

    def differs(column: str) -> Column:
        old, new = F.col(column), F.col(f"_new.{column}")
        return ~old.eqNullSafe(new) if mode == "null_safe" else F.coalesce(old != new, F.lit(False))

    return F.col("_new").isNotNull() & reduce(lambda a, b: a | b, [differs(c) for c in tracked])


def _opened(key: str, tracked: Sequence[str], value, run: Column, stamp: Column) -> dict[str, Column]:
    """Columns of a version that starts at the run date."""
    return {
        "_scd_key": F.concat(text(F.col(key)), F.lit("_"), text(run)),
        key: F.col(key),
        **{c: value(c) for c in tracked},
        "valid_from": run,
        "valid_to": day(OPEN_END),
        "is_current": F.lit(True),
        "_created_at": stamp,
        "_updated_at": stamp,
    }


def scd2_apply(
    dim: DataFrame,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    run_date,
    mode: str = "plain",
    now=None,
) -> DataFrame:
    """The dimension after one run, as a plan over ``dim`` and the written ``source``.

    ``source`` has one row per changed or new key.

    A changed key's current version is closed on the day before ``run_date`` and a new one is
    opened; a key without a current version gets its first; every other row stays. Applying
    the same source for the same date again changes nothing.

    Closed versions, which grow without end, are copied without a join or shuffle. Current
    rows are joined once, and a changed one yields both of its versions there.
    """
    if mode not in ("plain", "null_safe"):
        raise ValueError("mode: plain or null_safe")
    run, stamp, columns = day(run_date), instant(now), dim.columns
    unique = unique_batch(source.select(key, *tracked), [key])
    incoming = unique.table
    current = dim.filter("is_current")

    def version(parts: dict[str, Column]) -> Column:
        return F.struct(*[parts.get(c, F.lit(None)).cast(dim.schema[c].dataType).alias(c) for c in columns])

    unchanged = {c: F.col(c) for c in columns}
    ended = unchanged | {"valid_to": F.date_sub(run, 1), "is_current": F.lit(False), "_updated_at": stamp}
    successor = _opened(key, tracked, lambda c: F.col(f"_new.{c}"), run, stamp)
    versions = F.when(
        _changed(tracked, mode), F.array(version(ended), version(successor))
    ).otherwise(F.array(version(unchanged)))
    news = incoming.select(key, F.struct(*tracked).alias("_new"))
    carried = current.join(news, key, "left").select(F.inline(versions))

    known = keys_held(current, incoming, [key])
    first = incoming.join(known, key, "left_anti")
    arrived = first.select(F.inline(F.array(version(_opened(key, tracked, F.col, run, stamp)))))
    return dim.filter(~F.col("is_current")).unionByName(carried).unionByName(arrived)


def scd2_delta(
    current: DataFrame, source: DataFrame, key: str, tracked: Sequence[str], run_date, mode: str = "plain", now=None
) -> DataFrame:
    """Only the versions a run closes or opens, in their new state: what has to be stored.

    ``current`` has the current versions; the history is not read. A repeated run for the same
    date finds nothing to do.
    """
    if mode not in ("plain", "null_safe"):
        raise ValueError("mode: plain or null_safe")
    run, stamp, columns = day(run_date), instant(now), current.columns
    incoming = unique_batch(source.select(key, *tracked), [key]).table

    def version(parts: dict[str, Column]) -> Column:
        return F.struct(*[parts.get(c, F.lit(None)).cast(current.schema[c].dataType).alias(c) for c in columns])

    ended = {c: F.col(c) for c in columns} | {"valid_to": F.date_sub(run, 1), "is_current": F.lit(False), "_updated_at": stamp}
    successor = _opened(key, tracked, lambda c: F.col(f"_new.{c}"), run, stamp)
    news = incoming.select(key, F.struct(*tracked).alias("_new"))
    changed = current.join(news, key).filter(_changed(tracked, mode))
    first = incoming.join(current.select(key), key, "left_anti")
    return changed.select(F.inline(F.array(version(ended), version(successor)))).unionByName(
        first.select(F.inline(F.array(version(_opened(key, tracked, F.col, run, stamp)))))
    )


def scd2_publish(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    run_date,
    schema: StructType,
    layout: ByDate,
    mode: str = "plain",
    now=None,
) -> list:
    """One run on the stored dimension: rewrites the partitions in which a version closes or opens.

    The table lies under ``layout`` (by the start of validity), sorted by key and ``is_current``;
    the first run creates it. Returns the partitions rewritten. A second change of a key on the
    date of its first is an error, as both versions would start on that date.
    """
    column = layout.partition_column
    current = read_declared(spark, path, schema).filter("is_current").drop(column)
    delta = unique_batch(layout.assign(scd2_delta(current, source, key, tracked, run_date, mode, now)), ["_scd_key", "valid_from"])
    years = partition_values(delta.table, column)
    changed = upsert_partitions(
        spark, path, column, delta, ["_scd_key", "valid_from"], schema, (key, "is_current"),
        within=F.col(column).isin(years),
    )
    return changed.partitions


def scd2_current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def scd2_as_of(dim: DataFrame, when, inclusive: bool = False) -> DataFrame:
    """Versions valid on a date.

    A closed version's ``valid_to`` is its last valid day, so the exclusive comparison finds
    nothing on that day; ``inclusive`` does.
    """
    date = day(when)
    alive = F.col("valid_to") >= date if inclusive else F.col("valid_to") > date
    return dim.filter((F.col("valid_from") <= date) & alive)


def scd2_version_counts(dim: DataFrame, key: str) -> DataFrame:
    """Keys with more than one version, most versions first."""
    counts = dim.groupBy(key).agg(
        F.count("*").alias("version_count"),
        F.min("valid_from").alias("first_seen"),
        F.max("valid_from").alias("latest_change"),
    )
    return counts.filter(F.col("version_count") > 1).orderBy(F.desc("version_count"))


def scd2_asof_join(
    fact: DataFrame, dim: DataFrame, key: str, date_col: str, attributes: Sequence[str], unit: str = "YEAR"
) -> DataFrame:
    """Facts with the attributes their key had on their date; facts without a version drop out.

    Versions are laid out by ``unit``, so a fact meets only versions alive in its own unit: at most one per day of
    it, however long the history of its key. After the last unit in which anything began or ended a key has the
    same version for good, so all later facts share one unit; that unit comes from the versions, and the facts
    are read once. Facts are the side of the join Spark may split when one key has very many. The versions laid out
    are never broadcast: Spark takes them for as small as the compressed files of ``dim``, and would hold all of them
    in one table in every task.
    """
    ends = F.when(F.col("valid_to") < day(OPEN_END), F.col("valid_to"))
    last = dim.agg(F.max(F.greatest("valid_from", ends))).first()[0]
    step = F.expr(f"INTERVAL 1 {unit}")
    after = F.lit("0001-01-01").cast("date") if last is None else (F.trunc(day(last), unit) + step).cast("date")
    unit_of = lambda c: F.least(F.trunc(c, unit), after)
    alive = dim.filter(F.col("valid_from") <= F.col("valid_to")).select(key, "valid_from", "valid_to", *attributes)
    laid = alive.withColumn("_unit", F.explode(F.sequence(unit_of("valid_from"), unit_of("valid_to"), step))).withColumnRenamed(key, "_key")
    same = (F.col(key) == F.col("_key")) & (unit_of(date_col) == F.col("_unit"))
    during = (F.col(date_col) >= F.col("valid_from")) & (F.col(date_col) <= F.col("valid_to"))
    return fact.join(laid.hint("merge"), same & during).select(*fact.columns, *attributes)


def scd2_integrity(dim: DataFrame, key: str) -> DataFrame:
    """Broken keys: a reversed interval, overlapping versions, several current rows, a repeated version key.

    Versions of a key with one start date are folded before the window, so it sorts at most one
    row per key and calendar day, and the same rows answer all checks but the last.
    """
    proper = F.col("valid_to") >= F.col("valid_from")
    starts = dim.groupBy(key, "valid_from").agg(
        F.max(F.when(proper, F.col("valid_to"))).alias("until"),
        F.count_if(proper).alias("same_start"),
        F.count_if(F.col("valid_to") < F.col("valid_from")).alias("reversed"),
        F.count_if("is_current").alias("current"),
    )
    earlier = Window.partitionBy(key).orderBy("valid_from").rowsBetween(Window.unboundedPreceding, -1)
    overlaps = (F.col("same_start") > 0) & ((F.col("reached") >= F.col("valid_from")) | (F.col("same_start") > 1))
    by_key = (
        starts.withColumn("reached", F.max("until").over(earlier))
        .groupBy(key)
        .agg(
            F.sum("reversed").alias("reversed_interval"),
            F.count_if(F.coalesce(overlaps, F.lit(False))).alias("overlap"),
            F.sum("current").alias("several_current"),
        )
    )
    found = lambda name, least: F.when(F.col(name) > least, F.struct(F.lit(name).alias("violation"), F.col(name).alias("found")))
    folded = F.array_compact(F.array(found("reversed_interval", 0), found("overlap", 0), found("several_current", 1)))
    repeated = (
        dim.groupBy(key, "_scd_key").count().filter(F.col("count") > 1).groupBy(key).agg(F.count("*").alias("found"))
    )
    return by_key.select(key, F.inline(folded)).unionByName(
        repeated.select(key, F.lit("repeated_scd_key").alias("violation"), "found")
    )
