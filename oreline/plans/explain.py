"""Read facts off a plan through the public ``explain`` output."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

_BARE_NOT_NULL = "isnotnull("


def explained(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def _without_not_null(filters: str) -> str:
    """The filters without tests that something is not null, whatever stands in the parentheses."""
    while (start := filters.find(_BARE_NOT_NULL)) >= 0:
        depth, end = 1, start + len(_BARE_NOT_NULL)
        while depth and end < len(filters):
            depth += {"(": 1, ")": -1}.get(filters[end], 0)
            end += 1
        filters = filters[:start] + filters[end:]
    return filters


def partition_filters(df: DataFrame) -> list[str]:
    """One entry per file scan: its partition filters without bare not-null tests.

    An empty entry is a scan that reads every partition. The formatted plan describes
    each scan in its own block, starting with ``(n) Scan`` or ``(n) BatchScan``.
    """
    found = []
    for block in re.split(r"\n(?=\(\d+\) )", explained(df)):
        if not re.match(r"\(\d+\) (Batch)?Scan ", block) or "Location:" not in block:
            continue
        line = re.search(r"^PartitionFilters: \[(.*)\]$", block, re.M)
        filters = _without_not_null(line.group(1)) if line else ""
        found.append(filters.strip(" ,"))
    return found
