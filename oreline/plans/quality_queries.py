"""Quality check queries: every check for every ship date of the order lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from oreline.operators import quality as q
from oreline.plans.views import CHECKS, DAYS, LOG, VALIDATOR
from oreline.scratch import fresh_path
from oreline.sources import model

AS_OF = "1998-06-15"


def _log(spark: SparkSession, root: str, checks=q.ORDER_CHECKS, day=None) -> DataFrame:
    lines = model.order_lines(spark, root)
    return q.run_checks(lines, "orders_silver", "orders_incremental", checks, day)


def _one(position: int) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, root: str) -> DataFrame:
        return _log(spark, root, [q.ORDER_CHECKS[position]]).drop("check_id", "checked_at")

    return query


def dq_log(spark: SparkSession, root: str) -> DataFrame:
    """Append the history of all checks to the log table and read it."""
    path = fresh_path(spark, "dq-log")
    q.append_log(_log(spark, root), path, tasks=spark.sparkContext.defaultParallelism)
    return spark.read.parquet(path).drop("check_id", "checked_at")


def dq_summary(spark: SparkSession, root: str) -> DataFrame:
    return q.dq_summary(_log(spark, root, day=AS_OF), AS_OF).drop("checked_at")


def dq_gate(spark: SparkSession, root: str) -> DataFrame:
    return q.gate_by_day(_log(spark, root))


def _validator(suffix: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, root: str) -> DataFrame:
        lines = model.order_lines(spark, root)
        report = q.validate_table(lines, "orders_silver", "order_id")
        return report.filter(report.check_name.endswith(suffix))

    return query


QUERIES = {
    "dq_not_empty": _one(0),
    "dq_pk_not_null": _one(1),
    "dq_no_duplicates": _one(2),
    "dq_row_count_drift": _one(3),
    "dq_valid_values": _one(4),
    "dq_log": dq_log,
    "dq_summary": dq_summary,
    "dq_gate": dq_gate,
    "validator_row_count": _validator("row_count"),
    "validator_pk_not_null": _validator("_not_null"),
    "validator_no_duplicates": _validator("_no_duplicates"),
}

ORACLE = {
    **{name: f"with {DAYS} {sql}" for name, sql in CHECKS.items()},
    **{name: f"with {DAYS} {sql}" for name, sql in VALIDATOR.items()},
    "dq_log": f"with {LOG} select * from log",
    "dq_summary": f"""
        with {LOG} select check_name, severity, status, expected_value, actual_value, message from log
        where run_date = date '{AS_OF}'""",
    "dq_gate": f"""
        with {LOG}
        select run_date, count(*) filter (where severity = 'CRITICAL' and status = 'FAILED') = 0 as proceed,
               count(*) filter (where severity = 'CRITICAL' and status = 'FAILED') as critical_failures,
               count(*) filter (where severity = 'WARNING' and status = 'FAILED') as warnings
        from log group by run_date""",
}
