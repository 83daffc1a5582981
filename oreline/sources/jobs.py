"""Which jobs read the most: job history from Spark event logs, and its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.functions.scalars import instant, size_gb
from oreline.scratch import written
from oreline.sources.schemas import JOBS, conform

_EVENTS = """
    `Event` string, `executionId` bigint, `description` string, `time` bigint, `User` string,
    `Properties` struct<`spark.sql.execution.id`: string>,
    `Stage IDs` array<bigint>, `Stage ID` bigint, `App ID` string,
    `Task Metrics` struct<`Executor Run Time`: bigint, `Input Metrics`: struct<`Bytes Read`: bigint>>
"""
_SQL = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecution"


def jobs_from_event_logs(spark: SparkSession, path: str) -> DataFrame:
    """One row per SQL execution of the event logs under ``path``.

    The logs are parsed once; the few fields needed are kept as a table. Bytes read stand for bytes processed and task run time for slot time; nothing in a log
    corresponds to billed bytes, so those are NULL. Task events are summed per stage before
    they are joined.
    """
    log = spark.read.schema(_EVENTS).option("recursiveFileLookup", "true").json(path)
    kinds = (
        "SparkListenerApplicationStart",
        "SparkListenerJobStart",
        "SparkListenerTaskEnd",
        f"{_SQL}Start",
        f"{_SQL}End",
    )
    needed = log.filter(F.col("Event").isin(*kinds))
    log = written(
        needed.select(
            F.col("_metadata.file_path").alias("file"),
            "Event",
            "executionId",
            "description",
            F.col("time").alias("started"),
            F.col("User").alias("owner"),
            F.col("App ID").alias("app"),
            F.col("Properties").getField("spark.sql.execution.id").cast("bigint").alias("job_execution"),
            F.col("Stage IDs").alias("stages"),
            F.col("Stage ID").alias("stage"),
            F.col("Task Metrics.Input Metrics.Bytes Read").alias("bytes_read"),
            F.col("Task Metrics.Executor Run Time").alias("run_ms"),
        ),
        "event-log",
    )

    def of(event: str) -> DataFrame:
        return log.filter(F.col("Event") == event)

    user = of("SparkListenerApplicationStart").select("file", "app", "owner")
    started = of(f"{_SQL}Start").select("file", "executionId", "description", "started")
    ended = of(f"{_SQL}End").select("file", "executionId", F.lit(True).alias("finished"))
    stages = of("SparkListenerJobStart").select(
        "file",
        F.col("job_execution").alias("executionId"),
        F.explode("stages").alias("stage"),
    ).distinct()
    tasks = (
        of("SparkListenerTaskEnd")
        .groupBy("file", "stage")
        .agg(F.sum("bytes_read").alias("bytes_read"), F.sum("run_ms").alias("run_ms"))
    )
    work = (
        stages.join(tasks, ["file", "stage"])
        .groupBy("file", "executionId")
        .agg(F.sum("bytes_read").alias("bytes_read"), F.sum("run_ms").alias("run_ms"))
    )
    jobs = (
        started.join(user, "file", "left")
        .join(ended, ["file", "executionId"], "left")
        .join(work, ["file", "executionId"], "left")
    )
    return conform(
        jobs.select(
            F.concat_ws("-", "app", "executionId").alias("job_id"),
            F.col("owner").alias("user_email"),
            F.coalesce("bytes_read", F.lit(0)).alias("total_bytes_processed"),
            F.lit(None).alias("total_bytes_billed"),
            F.coalesce("run_ms", F.lit(0)).alias("total_slot_ms"),
            F.timestamp_millis("started").alias("creation_time"),
            F.col("description").alias("query"),
            F.lit("QUERY").alias("job_type"),
            F.when(F.col("finished"), "DONE").otherwise("RUNNING").alias("state"),
        ),
        JOBS,
    )


def expensive_jobs(jobs: DataFrame, as_of=None, days: int = 7, limit: int = 20) -> DataFrame:
    """The finished queries of the last ``days`` that read the most."""
    since: Column = instant(as_of) - F.make_dt_interval(days=F.lit(days))
    recent = (F.col("creation_time") >= since) & (F.col("job_type") == "QUERY") & (F.col("state") == "DONE")
    return (
        jobs.filter(recent)
        .orderBy(F.desc_nulls_last("total_bytes_processed"))
        .limit(limit)
        .select(
            "job_id",
            "user_email",
            size_gb(F.col("total_bytes_processed")).alias("gb_processed"),
            size_gb(F.col("total_bytes_billed")).alias("gb_billed"),
            F.round(F.col("total_slot_ms") / 1000.0, 1).alias("slot_seconds"),
            "creation_time",
            F.substring("query", 1, 100).alias("query_preview"),
        )
    )
