"""Tables the layout queries read, written once per session and content of the input folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from oreline.scratch import fresh_path
from oreline.sources.files import content_mark, exists

_PATHS: dict[tuple[str, str, str, str], str] = {}


def stored(spark: SparkSession, root: str, name: str, write: Callable[[str], None]) -> str:
    """Path of the stored table ``name`` for the input folder, written on first use."""
    key = (spark.conf.get("spark.app.id"), root, content_mark(spark, root), name)
    if key not in _PATHS or not exists(spark, _PATHS[key]):
        path = fresh_path(spark, name)
        write(path)
        _PATHS[key] = path
    return _PATHS[key]
