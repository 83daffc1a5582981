"""Put a computed result in place of the table it was computed from.

File tables have no MERGE. A result is first written to a staging table, so that neither a
lost executor nor a stopped job can touch the live files; publishing from the staging table
can be repeated until it succeeds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline.sources.files import NULL_PARTITION, data_files, delete_dir, exists, move, partition_dirs, read_text, write_text
from oreline.sources.schemas import conform


def read_declared(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path`` with the declared columns; no rows if there is no table yet.

    Types are never inferred from directory names: a text partition ``01`` stays text.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], StructType([f.__class__(f.name, f.dataType) for f in schema.fields]))
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def partition_values(df: DataFrame, column: str) -> list:
    """Distinct values of a partition column: as many as there are directories."""
    return [r[0] for r in df.select(column).distinct().collect()]


def publish_partitions(
    staged: DataFrame,
    path: str,
    column: str,
    touched: Iterable,
    sort_by: tuple[str, ...] = (),
    schema: StructType | None = None,
) -> list:
    """Overwrite the ``touched`` partitions with ``staged`` and remove those it leaves empty.

    ``staged`` must be a written table holding the complete new content of every touched
    partition. Files are sorted by ``sort_by`` inside, like the table's layout, and ``schema``
    is held to, NOT NULL columns included. Returns the removed partition values.
    """
    spark = staged.sparkSession
    filled = set(partition_values(staged, column))
    extra = filled - set(touched)
    if extra:
        raise ValueError(f"partitions not announced as touched: {sorted(map(str, extra))}")
    content = conform(staged, schema) if schema is not None else staged
    (
        content.hint("rebalance", column)
        .sortWithinPartitions(column, *sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    emptied = {NULL_PARTITION if v is None else str(v) for v in set(touched) - filled}
    for value, directory in partition_dirs(spark, path, column).items():
        if value in emptied:
            delete_dir(spark, directory)
    return sorted(emptied)


APPENDED = "_appended"


def append_once(df: DataFrame, path: str, column: str, token: str, sort_by: tuple[str, ...] = ()) -> bool:
    """Append ``df`` to a table partitioned by ``column``, once for each ``token`` however often it is tried.

    The rows are written to a hidden folder of the table; a journal then names its files, they are moved into
    place, and a mark says that the token is done. Tried again, a stopped append goes on from its journal, and a
    finished one does nothing (False). Large partitions are split over tasks.
    """
    spark = df.sparkSession
    done, journal = f"{path}/{APPENDED}/{token}.done", f"{path}/{APPENDED}/{token}.json"
    if exists(spark, done):
        return False
    if not exists(spark, journal):
        staged = f"{path}/_staged-{token}-{uuid.uuid4().hex}"
        df.hint("rebalance", column).sortWithinPartitions(column, *sort_by).write.partitionBy(column).parquet(staged)
        write_text(spark, journal, json.dumps({"staged": staged, "new": data_files(spark, staged)}))
    step = json.loads(read_text(spark, journal))
    for name in step["new"]:
        if exists(spark, f"{step['staged']}/{name}"):
            move(spark, f"{step['staged']}/{name}", f"{path}/{name}")
    write_text(spark, done, "")
    delete_dir(spark, step["staged"])
    delete_dir(spark, journal)
    return True


def publish_version(df: DataFrame, table: str, location: str, sort_by: tuple[str, ...] = ()) -> None:
    """Write a new copy at ``location`` and point an unpartitioned catalog table at it in one step.

    Readers see the old or the new table, never a mixture. The old files stay for the caller
    to keep or remove.
    """
    spark: SparkSession = df.sparkSession
    out = df.hint("rebalance").sortWithinPartitions(*sort_by) if sort_by else df
    out.write.parquet(location)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def in_partitions(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows of the given partitions, NULL partition included, as a pruned scan."""
    values = list(values)
    kept = F.col(column).isin([v for v in values if v is not None])
    if None in values:
        kept = kept | F.col(column).isNull()
    return df.filter(kept)
