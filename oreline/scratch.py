"""Written temporary tables in the folder all executors share.

A table written here cuts lineage and keeps its rows when an executor is lost, and the
files give Spark the exact size of the data, which it needs to choose a join strategy.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL_ROOTS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nothing has been written to yet."""
    return f"{scratch_root(spark)}/oreline/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the table that was written."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
