"""Split each user's events into sessions at pauses longer than a limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.scratch import written


def sessionize(events: DataFrame, user: str, ts: str, gap: str = "30 minutes", slice_unit: str = "HOUR") -> DataFrame:
    """Events with ``session_no``, counting 1, 2, ... per user; a pause of exactly ``gap`` stays inside.

    A user may own a large share of all events, and many events may share one time, so
    neither is gathered. Only distinct times are numbered, made unique in the map tasks, and
    only inside slices of time; a summary with one row per user and slice then says how many
    sessions came before a slice and whether its first time continues the last one. The
    events are joined to the numbered times as the side Spark may split.

    Events without a user are sliced by the minute at the widest, as they may be most of a busy
    hour. Events without a time get no session.
    """
    limit = F.expr(f"INTERVAL {gap}")
    # Inside a struct a missing user equals a missing user, in windows and joins alike.
    keyed = events.withColumn("_user", F.struct(user))
    times = keyed.filter(F.col(ts).isNotNull()).select("_user", ts).distinct()
    anonymous = F.col(f"_user.{user}").isNull()
    narrow = slice_unit if slice_unit.upper() in ("SECOND", "MILLISECOND", "MICROSECOND") else "MINUTE"
    sliced = times.withColumn("_slice", F.when(anonymous, F.date_trunc(narrow, F.col(ts))).otherwise(F.date_trunc(slice_unit, F.col(ts))))
    inside = Window.partitionBy("_user", "_slice").orderBy(ts)
    pause = F.when(F.col(ts) > F.lag(ts).over(inside) + limit, 1).otherwise(0)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.withColumn("_pause", pause).withColumn("_inner", F.sum("_pause").over(so_far)).drop("_pause")
    # Read twice below: written, the events are scanned for their times once.
    local = written(local, "session-times")

    slices = local.groupBy("_user", "_slice").agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.max("_inner").alias("_pauses")
    )
    across = Window.partitionBy("_user").orderBy("_slice")
    last_before = F.lag("_last").over(across)
    opens = F.when(last_before.isNull() | (F.col("_first") > last_before + limit), 1).otherwise(0)
    earlier = F.sum(F.col("_opens") + F.col("_pauses")).over(across.rowsBetween(Window.unboundedPreceding, -1))
    offsets = slices.withColumn("_opens", opens).select(
        "_user", "_slice", (F.coalesce(earlier, F.lit(0)) + F.col("_opens")).alias("_offset")
    )
    numbered = local.join(offsets, ["_user", "_slice"]).select(
        "_user", ts, (F.col("_offset") + F.col("_inner")).alias("session_no")
    )
    return keyed.join(numbered, ["_user", ts], "left").select(*events.columns, "session_no")


def session_summary(sessions: DataFrame, user: str, ts: str) -> DataFrame:
    """One row per session; partial results are formed before the shuffle."""
    return sessions.filter(F.col("session_no").isNotNull()).groupBy(user, "session_no").agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count("*").alias("events")
    )
