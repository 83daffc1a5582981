"""Queries over the versioned customer dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.operators import scd2, scd2_apart
from oreline.plans.views import DIM, DIM_BROKEN, DIM_NULL_SAFE, ORDERS_ALL
from oreline.scratch import fresh_path, written
from oreline.sources import model
from oreline.sources.layout import ByDate, write_partitioned
from oreline.sources.publish import read_declared
from oreline.sources.schemas import DIM_CUSTOMER, DIM_CUSTOMER_APART, DIM_CUSTOMER_STORED

KEY = "customer_id"
TRACKED = ("city", "state", "customer_name", "customer_segment")


def _changes(silver: DataFrame, run_date: str) -> DataFrame:
    return silver.filter(F.col("_silver_updated_date") == F.lit(run_date).cast("date"))


def _apply(spark: SparkSession, root: str, dim: DataFrame, run_date: str, mode: str = "plain") -> DataFrame:
    changes = _changes(model.customers_silver(spark, root, run_date), run_date)
    return _stored(scd2.scd2_apply(dim, changes, KEY, TRACKED, run_date, mode))


def _stored(dim: DataFrame) -> DataFrame:
    """A run leaves a table behind, which the next run and the lookups read."""
    return written(dim, "dim-customer")


def _initial(spark: SparkSession, root: str) -> DataFrame:
    return _stored(model.dim_customer_initial(spark, root))


def _history(spark: SparkSession, root: str) -> DataFrame:
    """The dimension after its first load and two runs."""
    first = _apply(spark, root, _initial(spark, root), model.FIRST_RUN)
    return _apply(spark, root, first, model.SECOND_RUN)


def _business(dim: DataFrame) -> DataFrame:
    return dim.drop("_created_at", "_updated_at")


BY_START = ByDate("valid_from", unit="year")


def scd2_merge(spark: SparkSession, root: str) -> DataFrame:
    """The stored dimension after two runs that read and rewrite its current versions only."""
    path = fresh_path(spark, "dim-customer")
    scd2_apart.build_apart(model.dim_customer_initial(spark, root), path, KEY, DIM_CUSTOMER)
    for run in (model.FIRST_RUN, model.SECOND_RUN):
        changes = _changes(model.customers_silver(spark, root, run), run)
        scd2_apart.publish_apart(spark, path, changes, KEY, TRACKED, run, DIM_CUSTOMER_APART)
    return _business(read_declared(spark, path, DIM_CUSTOMER_APART)).drop(scd2_apart.BY_END.partition_column)


def scd2_merge_by_start(spark: SparkSession, root: str) -> DataFrame:
    """The same two runs on a dimension laid out by the start of validity: partitions with a closed or opened
    version are rewritten."""
    path = fresh_path(spark, "dim-customer")
    write_partitioned(model.dim_customer_initial(spark, root), path, BY_START, (KEY, "is_current"), DIM_CUSTOMER)
    for run in (model.FIRST_RUN, model.SECOND_RUN):
        changes = _changes(model.customers_silver(spark, root, run), run)
        scd2.scd2_publish(spark, path, changes, KEY, TRACKED, run, DIM_CUSTOMER_STORED, BY_START)
    return _business(read_declared(spark, path, DIM_CUSTOMER_STORED)).drop(BY_START.partition_column)


def scd2_merge_null_safe(spark: SparkSession, root: str) -> DataFrame:
    return _business(_apply(spark, root, _initial(spark, root), model.FIRST_RUN, mode="null_safe"))


def scd2_current(spark: SparkSession, root: str) -> DataFrame:
    return scd2.scd2_current(_history(spark, root)).select(KEY, "customer_name", "city", "customer_segment")


# The last valid day of the versions the first run closed.
LAST_DAY_BEFORE = "1997-05-31"


def scd2_as_of(spark: SparkSession, root: str) -> DataFrame:
    return scd2.scd2_as_of(_history(spark, root), LAST_DAY_BEFORE).select(KEY, "customer_name", "city")


def scd2_as_of_inclusive(spark: SparkSession, root: str) -> DataFrame:
    found = scd2.scd2_as_of(_history(spark, root), LAST_DAY_BEFORE, inclusive=True)
    return found.select(KEY, "customer_name", "city")


def scd2_version_counts(spark: SparkSession, root: str) -> DataFrame:
    return scd2.scd2_version_counts(_history(spark, root), KEY)


def scd2_asof_join(spark: SparkSession, root: str) -> DataFrame:
    facts = model.orders(spark, root).select("order_id", KEY, "order_date", "order_amount")
    return scd2.scd2_asof_join(facts, _history(spark, root), KEY, "order_date", ("city", "customer_segment"))


def scd2_integrity(spark: SparkSession, root: str) -> DataFrame:
    """A dimension that took two changes on one date."""
    first = _apply(spark, root, _initial(spark, root), model.FIRST_RUN)
    again = model.customers_silver(spark, root, model.SECOND_RUN)
    return scd2.scd2_integrity(_stored(scd2.scd2_apply(first, again, KEY, TRACKED, model.FIRST_RUN)), KEY)


QUERIES = {
    "scd2_merge": scd2_merge,
    "scd2_merge_by_start": scd2_merge_by_start,
    "scd2_merge_null_safe": scd2_merge_null_safe,
    "scd2_current": scd2_current,
    "scd2_as_of": scd2_as_of,
    "scd2_as_of_inclusive": scd2_as_of_inclusive,
    "scd2_version_counts": scd2_version_counts,
    "scd2_asof_join": scd2_asof_join,
    "scd2_integrity": scd2_integrity,
}


def _as_of(operator: str) -> str:
    return f"""
        with {DIM} select customer_id, customer_name, city from dim_2
        where valid_from <= date '{LAST_DAY_BEFORE}' and valid_to {operator} date '{LAST_DAY_BEFORE}'"""


ORACLE = {
    "scd2_merge": f"with {DIM} select * from dim_2",
    "scd2_merge_by_start": f"with {DIM} select * from dim_2",
    "scd2_merge_null_safe": f"with {DIM_NULL_SAFE} select * from dim_1",
    "scd2_current": f"with {DIM} select customer_id, customer_name, city, customer_segment from dim_2 where is_current",
    "scd2_as_of": _as_of(">"),
    "scd2_as_of_inclusive": _as_of(">="),
    "scd2_version_counts": f"""
        with {DIM}
        select customer_id, count(*) as version_count, min(valid_from) as first_seen, max(valid_from) as latest_change
        from dim_2 group by customer_id having count(*) > 1""",
    "scd2_asof_join": f"""
        with {DIM}, {ORDERS_ALL}
        select order_id, o.customer_id, order_date, order_amount, city, customer_segment
        from orders_all o join dim_2 d on o.customer_id = d.customer_id
         and order_date between valid_from and valid_to""",
    "scd2_integrity": f"""
        with {DIM_BROKEN},
        numbered as (select *, row_number() over () as n from dim_2),
        regular as (select * from numbered where valid_to >= valid_from),
        clashes as (
          select distinct b.customer_id, b.valid_from from regular a join regular b
            on a.customer_id = b.customer_id and a.n <> b.n
           and a.valid_from <= b.valid_from and a.valid_to >= b.valid_from
        )
        select customer_id, 'reversed_interval' as violation, count(*) as found from dim_2
        where valid_to < valid_from group by customer_id
        union all
        select customer_id, 'overlap', count(*) from clashes group by customer_id
        union all
        select customer_id, 'several_current', count(*) from dim_2 where is_current
        group by customer_id having count(*) > 1
        union all
        select customer_id, 'repeated_scd_key', count(*) from (
          select customer_id, _scd_key from dim_2 group by customer_id, _scd_key having count(*) > 1
        ) group by customer_id""",
}
