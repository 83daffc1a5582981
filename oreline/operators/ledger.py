"""Extraction without a trusted time: what differs from a ledger of the rows already loaded.

The ledger has the hash of every row loaded, by key, and lies in buckets of the key. A batch is the source rows
whose hash the ledger lacks, whatever their ``updated_at`` says, so a row that arrives late or changes without a
new time is found. The ledger moves on only after the batch is loaded.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from oreline.operators.reconcile import key_bucket, row_hash
from oreline.scratch import written
from oreline.sources.publish import in_partitions, partition_values, publish_partitions, read_declared

BUCKET, HASH = "ledger_bucket", "row_hash"
BUCKETS = 64


def ledger_schema(source: StructType, keys: Sequence[str]) -> StructType:
    kept = [StructField(k, source[k].dataType, False) for k in keys]
    return StructType([*kept, StructField(HASH, LongType(), False), StructField(BUCKET, IntegerType(), False)])


@dataclass(frozen=True)
class LedgerExtract:
    """Source rows to load, keys the source no longer has, and the ledger's rows for them (written tables)."""

    batch: DataFrame
    gone: DataFrame
    entries: DataFrame


def extract_by_ledger(
    spark: SparkSession, source: DataFrame, ledger_path: str, keys: Sequence[str], columns: Sequence[str] | None = None, buckets: int = BUCKETS
) -> LedgerExtract:
    """Rows of ``source``, one for each key, that are new or differ in ``columns`` (default: all) from the last load.

    One pass over the source and the ledger's keys and hashes; whole rows are only kept where they differ. A key
    twice in the source with different rows comes twice, and the load's own rule for repeated keys decides; a row
    without a key is left to that rule too, every time. ``gone`` is of use for full snapshots only.
    """
    compared = list(columns or source.columns)
    known = read_declared(spark, ledger_path, ledger_schema(source.schema, keys)).select(*keys, F.col(HASH).alias("_known"))
    hashed = source.withColumn(HASH, row_hash(compared))
    changed = hashed.join(known, list(keys), "left").filter(~F.col(HASH).eqNullSafe(F.col("_known")))
    batch = written(changed.drop("_known"), "ledger-batch")
    gone = written(known.select(*keys).join(source.select(*keys).distinct(), list(keys), "left_anti"), "ledger-gone")
    # Of several rows with one key the ledger keeps one hash; the others come again until the source settles.
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    entries = batch.filter(has_key).groupBy(*keys).agg(F.max(HASH).alias(HASH)).withColumn(BUCKET, key_bucket(keys, buckets))
    return LedgerExtract(batch.drop(HASH), gone, written(entries, "ledger-entries"))


def store_ledger(spark: SparkSession, ledger_path: str, extract: LedgerExtract, keys: Sequence[str], forget_gone: bool = False, buckets: int = BUCKETS) -> list:
    """Enter a loaded batch; with ``forget_gone`` the keys the source no longer has leave the ledger.

    Rewrites the buckets of those keys only. To be called after the load: until then a stopped run extracts the
    same batch again.
    """
    schema = ledger_schema(extract.entries.schema, keys)
    leaving = extract.gone.withColumn(BUCKET, key_bucket(keys, buckets)) if forget_gone else None
    touched = set(partition_values(extract.entries, BUCKET)) | (set(partition_values(leaving, BUCKET)) if leaving is not None else set())
    if not touched:
        return []
    held = in_partitions(read_declared(spark, ledger_path, schema), BUCKET, touched)
    kept = held.join(extract.entries.select(*keys), list(keys), "left_anti")
    if leaving is not None:
        kept = kept.join(leaving.select(*keys), list(keys), "left_anti")
    content = written(kept.select(*schema.names).unionByName(extract.entries.select(*schema.names)), "ledger")
    publish_partitions(content, ledger_path, BUCKET, touched, tuple(keys), schema)
    return sorted(touched)
