"""Compare a Spark result with DuckDB's answer, whatever the order of rows and columns."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(root: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{root}/{table}.parquet')")
    return con


def _cell(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ", timespec="microseconds")
    return str(value)


def _rows(names, rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, df.collect())


def duck_rows(con, sql: str):
    con.execute(sql)
    names = [d[0] for d in con.description]
    return sorted(names), _rows(names, con.fetchall())


_TYPE_NAMES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "timestamp_ntz": "TIMESTAMP",
}


def spark_types(df) -> dict[str, str]:
    return {name: _TYPE_NAMES.get(kind, kind.upper()) for name, kind in df.dtypes}


def duck_types(con) -> dict[str, str]:
    """Column types of the statement last executed."""
    return {d[0]: str(d[1]).replace(" ", "") for d in con.description}
