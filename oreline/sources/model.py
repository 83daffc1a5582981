"""Bronze and Silver tables derived from the raw star schema, over all of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.functions.scalars import OPEN_END, day
from oreline.session import configure
from oreline.sources.schemas import CUSTOMERS_SILVER, MONEY, ORDERS_SOURCE, RAW, conform


def raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    return configure(spark).read.schema(RAW[table]).parquet(f"{root}/{table}.parquet")


def _geography(spark: SparkSession, root: str) -> DataFrame:
    """Nation with its region; both tables have a fixed size (25 and 5 rows)."""
    nation, region = raw(spark, root, "nation"), raw(spark, root, "region")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def _status() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "F", "COMPLETED")
        .when(F.col("o_orderstatus") == "O", "PENDING")
        .otherwise("CANCELLED")
    )


def orders(spark: SparkSession, root: str) -> DataFrame:
    """Order facts with region; an order is last touched 30 days after it is placed."""
    customers = raw(spark, root, "customer").select("c_custkey", "c_nationkey")
    facts = raw(spark, root, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    located = facts.join(
        F.broadcast(_geography(spark, root)), F.col("c_nationkey") == F.col("n_nationkey")
    )
    placed = F.col("o_orderdate").cast("timestamp")
    return located.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        (F.col("o_orderkey") % 200).cast("string").alias("product_id"),
        F.col("o_totalprice").cast(MONEY).alias("order_amount"),
        _status().alias("order_status"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("r_name").alias("region"),
        F.col("o_orderpriority").alias("product_category"),
        (placed + F.make_dt_interval(days=F.lit(30), secs=F.col("o_custkey") % 86400)).alias("updated_at"),
    )


def orders_source(spark: SparkSession, root: str) -> DataFrame:
    return conform(orders(spark, root), ORDERS_SOURCE)


def orders_before(spark: SparkSession, root: str, loaded_until: str) -> DataFrame:
    """Silver as an earlier load left it: orders placed by then, open ones still pending.

    Some open orders were planned for another date, some for none; the load moves them.
    ``product_category`` exists only here, so a merge has a column it must leave alone.
    """
    cut = F.lit(loaded_until).cast("timestamp")
    known = orders(spark, root).filter(F.col("order_date").cast("timestamp") <= cut)
    settled = F.col("updated_at") <= cut
    kind = F.col("customer_id").cast("bigint") % 5
    planned = F.when(settled | (kind > 1), F.col("order_date")).when(kind == 0, F.date_sub("order_date", 400))
    return known.withColumns(
        {
            "order_date": planned,
            "order_status": F.when(settled, F.col("order_status")).otherwise("PENDING"),
            "updated_at": F.when(settled, F.col("updated_at")).otherwise(F.col("order_date").cast("timestamp")),
            "_silver_updated_at": cut,
            "_ingestion_date": cut.cast("date"),
        }
    )


def order_lines(spark: SparkSession, root: str) -> DataFrame:
    """Order lines by ship date, with the duplicate keys, missing keys, missing dates and odd statuses of a raw feed."""
    quantity, tax = F.col("l_quantity"), F.col("l_tax")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    status = (
        F.when((quantity == 1) & (tax == 0), "REFUNDED")
        .when(F.col("l_returnflag") == "A", "COMPLETED")
        .when(F.col("l_returnflag") == "N", "PENDING")
        .otherwise("CANCELLED")
    )
    return raw(spark, root, "lineitem").select(
        F.when((quantity == 50) & (tax == 0.08), F.lit(None)).otherwise(key).alias("order_id"),
        F.col("l_extendedprice").cast(MONEY).alias("order_amount"),
        status.alias("order_status"),
        F.when(~((quantity == 49) & (tax == 0.07)), F.col("l_shipdate").cast("date")).alias("_ingestion_date"),
    )


def events(spark: SparkSession, root: str) -> DataFrame:
    return raw(spark, root, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.col("user_id").cast("string").alias("user_id"),
        F.col("props").alias("event_payload"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
    )


def web_orders(spark: SparkSession, root: str) -> DataFrame:
    """Orders from the event stream, placed in the region of their customer; every event is one.

    Some are for a date 45 days ahead, some have none.
    """
    date = F.col("ts").cast("date")
    late = F.when(F.col("event_id") % 89 == 0, F.date_add(date, 45)).otherwise(date)
    placed_on = F.when(F.col("event_id") % 97 != 0, late)
    customers = raw(spark, root, "customer").select("c_custkey", "c_nationkey")
    placed = raw(spark, root, "events").join(customers, F.col("user_id") == F.col("c_custkey"), "left")
    located = placed.join(
        F.broadcast(_geography(spark, root)), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    status = (
        F.when(F.col("event_type") == "purchase", "COMPLETED")
        .when(F.col("event_type") == "error", "CANCELLED")
        .otherwise("PENDING")
    )
    return located.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("value").cast(MONEY).alias("order_amount"),
        status.alias("order_status"),
        placed_on.alias("order_date"),
        F.col("r_name").alias("region"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def raw_events(spark: SparkSession, root: str) -> DataFrame:
    return raw(spark, root, "events").select(
        F.col("props").alias("raw_payload"),
        F.col("event_type").alias("source_system"),
        F.col("ts").cast("timestamp").alias("_ingestion_ts"),
    )


def customers_by_id(spark: SparkSession, root: str) -> DataFrame:
    """Customers with ids spread over the integer range layout and past both of its ends."""
    located = raw(spark, root, "customer").join(
        F.broadcast(_geography(spark, root)), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return located.select(
        (F.col("c_custkey") * F.when(F.col("c_custkey") % 50 == 1, -7000).otherwise(7000)).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("segment"),
        F.date_add(day("2024-01-01"), F.col("c_nationkey")).alias("created_date"),
    )


# Run dates of the customer dimension.
DIM_LOADED = "1995-01-01"
FIRST_RUN = "1997-06-01"
SECOND_RUN = "2000-01-01"


def _customers(spark: SparkSession, root: str, moved: Column) -> DataFrame:
    """Customers placed in their nation, or in the next one where ``moved`` holds."""
    key = F.when(moved, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    customers = raw(spark, root, "customer").withColumn("home", key)
    return customers.join(F.broadcast(_geography(spark, root)), F.col("home") == F.col("n_nationkey"))


def customers_silver(spark: SparkSession, root: str, run_date: str) -> DataFrame:
    """State of every customer at a run date.

    At the first run BUILDING customers with a small balance have moved, customers in debt
    have no segment, and FURNITURE rows were last touched earlier. At the second run the
    richest customers have a new name as well.
    """
    second = run_date == SECOND_RUN
    moved = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < 5000)
    name = F.col("c_name")
    if second:
        name = F.when(F.col("c_acctbal") > 8000, F.concat(name, F.lit(" II"))).otherwise(name)
    touched = day(run_date) if second else (
        F.when(F.col("c_mktsegment") == "FURNITURE", day(DIM_LOADED)).otherwise(day(run_date))
    )
    state = _customers(spark, root, moved).select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        name.alias("customer_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("customer_segment"),
        touched.alias("_silver_updated_date"),
    )
    return conform(state, CUSTOMERS_SILVER)


def dim_customer_initial(spark: SparkSession, root: str) -> DataFrame:
    """The dimension after its first load; MACHINERY customers arrive later."""
    customers = _customers(spark, root, F.lit(False)).filter(F.col("c_mktsegment") != "MACHINERY")
    return customers.select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(f"_{DIM_LOADED}")).alias("_scd_key"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.col("c_mktsegment").alias("customer_segment"),
        day(DIM_LOADED).alias("valid_from"),
        day(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit(DIM_LOADED).cast("timestamp").alias("_created_at"),
        F.lit(DIM_LOADED).cast("timestamp").alias("_updated_at"),
    )


def jobs(spark: SparkSession, root: str) -> DataFrame:
    """A job history with one job per event."""
    return raw(spark, root, "events").select(
        F.col("event_id").cast("string").alias("job_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("@example.com")).alias("user_email"),
        (F.col("event_id") * 104857600).alias("total_bytes_processed"),
        (F.col("event_id") * 104857600 + 10485760).alias("total_bytes_billed"),
        (F.col("event_id") * 137).alias("total_slot_ms"),
        F.col("ts").cast("timestamp").alias("creation_time"),
        F.concat(F.lit("SELECT * FROM events WHERE props = '"), F.repeat("props", F.lit(10)), F.lit("'")).alias("query"),
        F.when(F.col("event_type") == "signup", "LOAD").otherwise("QUERY").alias("job_type"),
        F.when(F.col("event_type") == "error", "RUNNING").otherwise("DONE").alias("state"),
    )
