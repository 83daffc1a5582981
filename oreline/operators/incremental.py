"""Watermark-driven incremental load of a fact table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline.functions.scalars import day, instant
from oreline.operators.merge import keys_held, unique_batch, upsert_partitions
from oreline.scratch import written
from oreline.sources.files import data_files, delete_dir
from oreline.sources.publish import read_declared
from oreline.sources.schemas import PIPELINE_MARKS, PIPELINE_WATERMARKS, conform

PASS = "PASS"
FAIL = "FAIL — investigate before proceeding"


def _window(column: str, lo, hi, lookback: str | None = None) -> Column:
    start = instant(lo)
    if lookback:
        start = start - F.expr(f"INTERVAL {lookback}")
    return (F.col(column) > start) & (F.col(column) <= instant(hi))


def extract_batch(source: DataFrame, lo, hi, ts_col: str = "updated_at", lookback: str | None = None) -> DataFrame:
    """Source rows changed after ``lo`` and up to ``hi``.

    A row that arrives late, with a time before ``lo``, is missed; ``lookback`` reads again
    that much before ``lo``, which is safe because the merge is repeatable.
    """
    return source.filter(_window(ts_col, lo, hi, lookback))


def seed_watermarks(watermarks: DataFrame, seeds: DataFrame, now=None, updated_by: str = "manual_init") -> DataFrame:
    """Add pipelines that have no watermark yet: ``seeds`` has a name and a start time each."""
    fresh = seeds.join(watermarks.select("pipeline_name"), "pipeline_name", "left_anti")
    rows = fresh.withColumns(
        {
            "last_run_ts": instant(now),
            "records_processed": F.lit(0).cast("bigint"),
            "updated_by": F.lit(updated_by),
        }
    )
    return watermarks.unionByName(conform(rows, PIPELINE_WATERMARKS))


def advance_watermark(
    watermarks: DataFrame, pipeline: str, ts, records: int, updated_by: str, now=None
) -> DataFrame:
    """Move one pipeline's watermark; an unknown pipeline is an error."""
    mine = F.col("pipeline_name") == pipeline
    if watermarks.filter(mine).isEmpty():
        raise ValueError(f"no watermark for pipeline {pipeline}")
    changes = {
        "last_processed_ts": instant(ts),
        "last_run_ts": instant(now),
        "records_processed": F.lit(records).cast("bigint"),
        "updated_by": F.lit(updated_by),
    }
    return watermarks.withColumns({c: F.when(mine, v).otherwise(F.col(c)) for c, v in changes.items()})


def reconcile(
    source: DataFrame, batch: DataFrame, target: DataFrame, keys: list[str], lo, hi, ts_col: str = "updated_at"
) -> DataFrame:
    """Rows in the source window, in the batch, and batch keys found in the target.

    ``batch`` should be a written table, so that Spark knows its size. The three counts are stacked and folded into one row.
    """
    in_source = extract_batch(source, lo, hi, ts_col).agg(F.count("*").alias("n"))
    in_batch = batch.agg(F.count("*").alias("n"))
    found = keys_held(target, batch, keys)
    in_target = found.agg(F.count("*").alias("n"))
    stacked = (
        in_source.withColumn("side", F.lit("source"))
        .unionByName(in_batch.withColumn("side", F.lit("batch")))
        .unionByName(in_target.withColumn("side", F.lit("target")))
    )

    def side(name: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col("n")))

    return (
        stacked.agg(
            side("source").alias("source_records"),
            side("batch").alias("loaded_records"),
            side("target").alias("target_records"),
        )
        .withColumn("discrepancy", F.col("source_records") - F.col("loaded_records"))
        .withColumn("reconciliation_status", F.when(F.col("discrepancy") == 0, PASS).otherwise(FAIL))
    )


@dataclass(frozen=True)
class Load:
    """Outcome of one incremental run; ``moved_dates`` are the partition values of old and new versions."""

    records: int
    touched_partitions: list
    reconciliation: DataFrame
    moved_dates: DataFrame


def run_incremental(
    spark: SparkSession,
    source: DataFrame,
    target_path: str,
    partition_column: str,
    keys: list[str],
    lo,
    hi,
    run_date,
    schema: StructType,
    sort_by: tuple[str, ...] = (),
    now=None,
    lookback: str | None = None,
    on_duplicate: str = "error",
    on_null_key: str = "error",
    only_if_newer: str | None = None,
) -> Load:
    """Extract, upsert and reconcile one window. Advance the watermark only after this returns.

    A run that stops half-way is repeated with the same window: the upsert gives the same rows.
    """
    extract = extract_batch(source, lo, hi, lookback=lookback)
    if on_duplicate == "latest":
        # The rows before they are reduced to one per key are what the source is compared with.
        extract = written(extract, "extract")
    batch = unique_batch(extract, keys, on_duplicate, on_null_key, only_if_newer or "updated_at")
    loaded = extract if on_duplicate == "latest" else batch.table
    stamps = {"_silver_updated_at": instant(now), "_ingestion_date": day(run_date)}
    changed = upsert_partitions(
        spark, target_path, partition_column, batch, keys, schema, sort_by,
        only_if_newer=only_if_newer, stamps=stamps, report=[partition_column],
    )
    target = read_declared(spark, target_path, schema)
    report = reconcile(source, extract_batch(loaded, lo, hi), target, keys, lo, hi)
    records = batch.rows if loaded is batch.table else loaded.count()
    return Load(records, changed.partitions, report, changed.moved[partition_column])


def _marks(spark: SparkSession, path: str) -> DataFrame:
    return read_declared(spark, path, PIPELINE_MARKS)


def read_watermarks(spark: SparkSession, path: str) -> DataFrame:
    """The latest mark of each pipeline."""
    latest = F.max_by(F.struct(*PIPELINE_WATERMARKS.names), F.struct("mark_no", "last_run_ts", "last_processed_ts"))
    return _marks(spark, path).groupBy("pipeline_name").agg(latest.alias("mark")).select("mark.*")


def store_watermarks(watermarks: DataFrame, path: str) -> None:
    """Append the marks that differ from the stored ones, as one small file; no stored mark is ever touched.

    A stop before the file is in place leaves the old marks, and pipelines that end together each add their own.
    Marks of a pipeline are numbered, so that the latest is known whatever their times say.
    """
    spark = watermarks.sparkSession
    held = read_watermarks(spark, path).select("pipeline_name", F.struct(*PIPELINE_WATERMARKS.names).alias("_held"))
    last = _marks(spark, path).groupBy("pipeline_name").agg(F.max("mark_no").alias("_last"))
    marks = watermarks.join(held, "pipeline_name", "left").join(last, "pipeline_name", "left")
    fresh = marks.filter(~F.struct(*PIPELINE_WATERMARKS.names).eqNullSafe(F.col("_held")))
    numbered = written(conform(fresh.withColumn("mark_no", F.coalesce("_last", F.lit(0)) + 1), PIPELINE_MARKS), "watermarks")
    if not numbered.isEmpty():
        numbered.coalesce(1).write.mode("append").parquet(path)


def compact_watermarks(spark: SparkSession, path: str) -> int:
    """Replace the files of all marks by one with the latest marks; returns the number of files removed.

    The new file is complete before an old one goes, and a mark that is there twice is read once, so a stop in
    between loses nothing; marks that other pipelines add meanwhile are in files this run does not know of.
    """
    files = data_files(spark, path)
    latest = F.max_by(F.struct(*PIPELINE_MARKS.names), F.struct("mark_no", "last_run_ts", "last_processed_ts"))
    known = spark.read.schema(PIPELINE_MARKS).parquet(*[f"{path}/{name}" for name in files])
    kept = written(known.groupBy("pipeline_name").agg(latest.alias("mark")).select("mark.*"), "marks")
    conform(kept, PIPELINE_MARKS).coalesce(1).write.mode("append").parquet(path)
    for name in files:
        delete_dir(spark, f"{path}/{name}")
    return len(files)


def run_pipeline(
    spark: SparkSession, pipeline: str, source: DataFrame, watermark_path: str, hi, updated_by: str, now=None, **load
) -> Load:
    """One closed incremental run: read the pipeline's watermark, load up to ``hi``, then store ``hi``.

    ``load`` are the remaining arguments of ``run_incremental``. A run that fails leaves the
    watermark where it was, so the next one reads the same window again. An unknown pipeline
    is an error before anything is loaded.
    """
    marks = read_watermarks(spark, watermark_path)
    mine = marks.filter(F.col("pipeline_name") == pipeline).select("last_processed_ts").first()
    if mine is None:
        raise ValueError(f"no watermark for pipeline {pipeline}")
    done = run_incremental(spark, source, lo=mine[0], hi=hi, now=now, **load)
    own = advance_watermark(marks.filter(F.col("pipeline_name") == pipeline), pipeline, hi, done.records, updated_by, now)
    store_watermarks(own, watermark_path)
    return done
