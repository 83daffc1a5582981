"""Session settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the session zone: every date in the library is a UTC date."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("oreline")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("ORELINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())
