"""Data quality checks: one pass over the data answers every check for every run date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.functions.scalars import day, instant, text
from oreline.scratch import written
from oreline.sources.schemas import DQ_CHECK_LOG, conform

CRITICAL, WARNING = "CRITICAL", "WARNING"
PASSED, FAILED = "PASSED", "FAILED"


@dataclass(frozen=True)
class Outcome:
    """How a check reports: columns over the metrics of one run date."""

    passed: Column
    expected: str
    actual: Column
    message: Column


def _say(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else text(p) for p in parts])


@dataclass(frozen=True)
class Check:
    """A named check.

    ``metrics`` are aggregates over the rows of one day, by name. They must hold for a day
    without rows as well, where counts are read as zero.
    """

    name: str
    severity: str = CRITICAL

    def metrics(self) -> dict[str, Column]:
        return {}

    def outcome(self) -> Outcome:
        raise NotImplementedError


ROWS = "_rows"
ROWS_BEFORE = "_rows_before"


@dataclass(frozen=True)
class NotEmpty(Check):
    name: str = "not_empty"

    def outcome(self) -> Outcome:
        rows = F.col(ROWS)
        empty = F.lit("CRITICAL: Table is empty — upstream pipeline likely failed")
        return Outcome(rows > 0, "> 0 rows", text(rows), F.when(rows > 0, _say("Row count: ", rows)).otherwise(empty))


@dataclass(frozen=True)
class NotNull(Check):
    column: str = field(kw_only=True)

    def metrics(self) -> dict[str, Column]:
        return {f"_nulls_{self.column}": F.count_if(F.col(self.column).isNull())}

    def outcome(self) -> Outcome:
        nulls = F.col(f"_nulls_{self.column}")
        return Outcome(nulls == 0, "0 nulls", _say(nulls, " nulls"), _say(f"Null {self.column} count: ", nulls))


@dataclass(frozen=True)
class Unique(Check):
    """Every row has its own key. Rows without a key count as duplicates unless ``skip_nulls``.

    The distinct count is taken in two steps: keys are made unique in the map tasks, so copies
    of one key are not shuffled.
    """

    column: str = field(kw_only=True)
    skip_nulls: bool = field(default=False, kw_only=True)
    labels: tuple[str, str] = field(default=("Unique keys", "Duplicates"), kw_only=True)

    def metrics(self) -> dict[str, Column]:
        found = {f"_distinct_{self.column}": F.countDistinct(self.column)}
        if self.skip_nulls:
            found[f"_keyed_{self.column}"] = F.count(self.column)
        return found

    def outcome(self) -> Outcome:
        total = F.col(f"_keyed_{self.column}" if self.skip_nulls else ROWS)
        unique = F.col(f"_distinct_{self.column}")
        duplicates = total - unique
        keys, copies = self.labels
        return Outcome(
            duplicates == 0,
            "0 duplicates",
            _say(duplicates, " duplicates"),
            _say("Total: ", total, f" | {keys}: ", unique, f" | {copies}: ", duplicates),
        )


@dataclass(frozen=True)
class Drift(Check):
    """Row count against the day before; rises count like drops. Passes if that day is empty."""

    name: str = "row_count_drift"
    severity: str = WARNING
    percent: int = 30

    def outcome(self) -> Outcome:
        rows, before = F.col(ROWS), F.col(ROWS_BEFORE)
        change = F.try_divide(F.abs(rows - before), before) * 100
        shown = F.round(change, 1)
        return Outcome(
            (change <= self.percent) | (before == 0),
            f"<= {self.percent}% change vs yesterday",
            _say(shown, "% change"),
            _say("Today: ", rows, " | Yesterday: ", before, " | Change: ", shown, "%"),
        )


@dataclass(frozen=True)
class ValidValues(Check):
    """Only known values; NULL is left to ``NotNull``."""

    severity: str = WARNING
    column: str = field(kw_only=True)
    values: tuple[str, ...] = field(kw_only=True)
    noun: str = field(default="value", kw_only=True)

    def metrics(self) -> dict[str, Column]:
        column = F.col(self.column)
        return {f"_invalid_{self.column}": F.count_if(column.isNotNull() & ~column.isin(*self.values))}

    def outcome(self) -> Outcome:
        count = F.col(f"_invalid_{self.column}")
        return Outcome(
            count == 0,
            f"Only: {', '.join(self.values)}",
            _say(count, f" records with unexpected {self.noun}"),
            _say(
                f"Unexpected {self.noun} count: ",
                count,
                f" — upstream system may have added a new {self.noun} value",
            ),
        )


ORDER_CHECKS: tuple[Check, ...] = (
    NotEmpty(),
    NotNull("order_id_not_null", column="order_id"),
    Unique("no_duplicate_order_ids", column="order_id"),
    Drift(),
    ValidValues(
        "order_status_valid_values",
        column="order_status",
        values=("COMPLETED", "PENDING", "CANCELLED"),
        noun="status",
    ),
)


def profile_days(
    df: DataFrame,
    checks: Sequence[Check],
    first: str | dt.date | None = None,
    last: str | dt.date | None = None,
    day_col: str = "_ingestion_date",
) -> DataFrame:
    """Metrics of every run date from ``first`` to ``last``, days without rows included.

    One scan, limited to those days and the one before, and one aggregate. The rest works on
    one row per day. Without ``first`` the whole table is profiled, from its first day to its
    last, and rows without a date as a run of their own.
    """
    spark, everything = df.sparkSession, first is None
    if everything:
        first, last = df.agg(F.min(day_col), F.max(day_col)).first()
    last = last or first
    metrics = {name: value for check in checks for name, value in check.metrics().items()}
    metrics[ROWS] = F.count("*")
    in_range = F.col(day_col).between(F.date_sub(day(first), 1), day(last))
    measured = (
        (df if everything else df.filter(in_range))
        .groupBy(F.col(day_col).alias("_day"))
        .agg(*[value.alias(name) for name, value in metrics.items()])
    )
    # The day before is an extra output row of each measured day, one day later.
    today = F.struct(F.col("_day").alias("run_date"), *metrics, F.lit(0).cast("bigint").alias(ROWS_BEFORE))
    nothing = [F.lit(0).cast("bigint").alias(name) for name in metrics]
    tomorrow = F.struct(F.date_add("_day", 1).alias("run_date"), *nothing, F.col(ROWS).alias(ROWS_BEFORE))
    followed = F.when(F.col("_day").isNull(), F.array(today)).otherwise(F.array(today, tomorrow))
    empty = F.struct(F.col("_day").alias("run_date"), *nothing, F.lit(0).cast("bigint").alias(ROWS_BEFORE))
    facts = measured.select(F.inline(followed))
    if first is not None:
        days = spark.range(1).select(F.explode(F.sequence(day(first), day(last))).alias("_day"))
        facts = facts.unionByName(days.select(F.inline(F.array(empty))))
        wanted = F.col("run_date").between(day(first), day(last))
        facts = facts.filter(wanted | F.col("run_date").isNull() if everything else wanted)
    return (
        facts
        .groupBy("run_date")
        .agg(*[F.sum(name).alias(name) for name in (*metrics, ROWS_BEFORE)])
    )


def run_checks(
    df: DataFrame,
    table: str,
    pipeline: str,
    checks: Sequence[Check],
    first: str | dt.date | None = None,
    last: str | dt.date | None = None,
    day_col: str = "_ingestion_date",
    now=None,
) -> DataFrame:
    """Log rows of every check for one run date, for each date of a range, or for the whole table."""
    rows = []
    for check in checks:
        result = check.outcome()
        rows.append(
            F.struct(
                F.uuid().alias("check_id"),
                F.lit(pipeline).alias("pipeline_name"),
                F.lit(table).alias("table_name"),
                F.lit(check.name).alias("check_name"),
                F.lit(check.severity).alias("severity"),
                F.when(result.passed, PASSED).otherwise(FAILED).alias("status"),
                F.lit(result.expected).alias("expected_value"),
                result.actual.alias("actual_value"),
                result.message.alias("message"),
                F.col("run_date"),
                instant(now).alias("checked_at"),
            )
        )
    return profile_days(df, checks, first, last, day_col).select(F.inline(F.array(*rows)))


def validation_checks(table: str, pk: str) -> tuple[Check, ...]:
    """Checks of the table validator, named after the table and key they look at."""
    return (
        _RowCount(f"{table}.row_count"),
        NotNull(f"{table}.{pk}_not_null", column=pk),
        Unique(f"{table}.{pk}_no_duplicates", column=pk, labels=("Unique", "Dupes")),
    )


@dataclass(frozen=True)
class _RowCount(Check):
    def outcome(self) -> Outcome:
        rows = F.col(ROWS)
        return Outcome(rows > 0, "> 0", text(rows), _say("Row count for ", F.col("run_date"), ": ", rows))


def validate_table(
    df: DataFrame, table: str, pk: str, first=None, last=None, day_col: str = "_ingestion_date"
) -> DataFrame:
    """The validator's report, one row per check and run date."""
    log = run_checks(df, table, "validator", validation_checks(table, pk), first, last, day_col)
    return log.select(
        "run_date",
        "check_name",
        "status",
        "severity",
        F.col("actual_value").alias("actual"),
        F.col("expected_value").alias("expected"),
        "message",
    )


def _blocking() -> Column:
    return (F.col("severity") == CRITICAL) & (F.col("status") == FAILED)


def gate(results: DataFrame) -> bool:
    """False if a CRITICAL check failed or nothing was checked; warnings never block."""
    found = results.agg(F.count("*").alias("checks"), F.max(F.coalesce(_blocking(), F.lit(False))).alias("blocked")).first()
    return found.checks > 0 and not found.blocked


def run_validation(
    df: DataFrame, table: str, pk: str, run_date, log_path: str, day_col: str = "_ingestion_date", now=None
) -> bool:
    """Check one run date, leave the results in the log and say whether the run may go on."""
    checks = validation_checks(table, pk)
    results = written(run_checks(df, table, "validator", checks, run_date, day_col=day_col, now=now), "validation")
    append_log(results, log_path)
    return gate(results)


def gate_by_day(results: DataFrame) -> DataFrame:
    return results.groupBy("run_date").agg(
        (~F.max(_blocking())).alias("proceed"),
        F.count_if(_blocking()).alias("critical_failures"),
        F.count_if((F.col("severity") != CRITICAL) & (F.col("status") == FAILED)).alias("warnings"),
    )


def append_log(results: DataFrame, path: str, tasks: int = 1) -> None:
    """Add results to the audit log, one partition per run date.

    The log has a few rows per run date, so writing it costs files and not bytes. A backfill
    of many dates opens their files from several ``tasks``.
    """
    rows = conform(results, DQ_CHECK_LOG)
    rows.repartition(tasks, "run_date").write.mode("append").partitionBy("run_date").parquet(path)


def dq_summary(log: DataFrame, as_of) -> DataFrame:
    """One day's results, critical checks and failures first."""
    severity = F.when(F.col("severity") == CRITICAL, 1).when(F.col("severity") == WARNING, 2).otherwise(3)
    status = F.when(F.col("status") == FAILED, 1).otherwise(2)
    return (
        log.filter(F.col("run_date") == day(as_of))
        .select("check_name", "severity", "status", "expected_value", "actual_value", "message", "checked_at")
        .orderBy(severity, status)
    )
