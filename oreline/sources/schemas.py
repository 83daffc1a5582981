"""Schemas of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

MONEY = "decimal(18,2)"

_TEXT, _LONG, _MONEY = StringType(), LongType(), DecimalType(18, 2)
_DATE, _TIME, _BOOL = DateType(), TimestampType(), BooleanType()
_INT, _DOUBLE, _NTZ = IntegerType(), DoubleType(), TimestampNTZType()


def _schema(columns: dict[str, DataType], required: tuple[str, ...] = ()) -> StructType:
    return StructType([StructField(name, kind, name not in required) for name, kind in columns.items()])


# Raw tables, as their files declare them.
RAW = {
    "region": _schema({"r_regionkey": _INT, "r_name": _TEXT}),
    "nation": _schema({"n_nationkey": _INT, "n_name": _TEXT, "n_regionkey": _INT}),
    "customer": _schema(
        {"c_custkey": _LONG, "c_name": _TEXT, "c_nationkey": _INT, "c_acctbal": _DOUBLE, "c_mktsegment": _TEXT}
    ),
    "orders": _schema(
        {
            "o_orderkey": _LONG, "o_custkey": _LONG, "o_orderstatus": _TEXT, "o_totalprice": _DOUBLE,
            "o_orderdate": _NTZ, "o_orderpriority": _TEXT,
        }
    ),
    "lineitem": _schema(
        {
            "l_orderkey": _LONG, "l_partkey": _LONG, "l_suppkey": _LONG, "l_linenumber": _INT,
            "l_quantity": _DOUBLE, "l_extendedprice": _DOUBLE, "l_discount": _DOUBLE, "l_tax": _DOUBLE,
            "l_returnflag": _TEXT, "l_linestatus": _TEXT, "l_shipdate": _NTZ,
        }
    ),
    "events": _schema(
        {
            "event_id": _LONG, "ts": _NTZ, "user_id": _LONG, "event_type": _TEXT, "value": _DOUBLE,
            "props": _TEXT,
        }
    ),
}

ORDERS_PARTITIONED = _schema(
    {
        "order_id": _TEXT, "customer_id": _TEXT, "product_id": _TEXT, "order_amount": _MONEY,
        "order_status": _TEXT, "order_date": _DATE, "region": _TEXT, "created_at": _TIME,
    },
    required=("order_id",),
)
EVENTS_PARTITIONED = _schema(
    {
        "event_id": _TEXT, "event_type": _TEXT, "user_id": _TEXT, "event_payload": _TEXT,
        "event_timestamp": _TIME,
    },
    required=("event_id",),
)
RAW_EVENTS = _schema({"raw_payload": _TEXT, "source_system": _TEXT, "_ingestion_ts": _TIME})
CUSTOMERS_RANGE_PARTITIONED = _schema(
    {
        "customer_id": _LONG, "customer_name": _TEXT, "city": _TEXT, "segment": _TEXT, "created_date": _DATE,
    },
    required=("customer_id",),
)
ORDERS_OPTIMISED = _schema(
    {
        "order_id": _TEXT, "customer_id": _TEXT, "product_id": _TEXT, "order_amount": _MONEY,
        "order_status": _TEXT, "order_date": _DATE, "region": _TEXT, "product_category": _TEXT,
    },
    required=("order_id",),
)
PIPELINE_WATERMARKS = _schema(
    {
        "pipeline_name": _TEXT, "last_processed_ts": _TIME, "last_run_ts": _TIME, "records_processed": _LONG,
        "updated_by": _TEXT,
    },
    required=("pipeline_name", "last_processed_ts"),
)
# Watermarks as stored: every mark a pipeline ever set, numbered.
PIPELINE_MARKS = StructType([*PIPELINE_WATERMARKS.fields, StructField("mark_no", _LONG)])
# Orders after a load, one partition per year of the order date.
ORDERS_SILVER = _schema(
    {
        "order_id": _TEXT, "customer_id": _TEXT, "product_id": _TEXT, "order_amount": _MONEY,
        "order_status": _TEXT, "order_date": _DATE, "region": _TEXT, "product_category": _TEXT, "updated_at": _TIME,
        "_silver_updated_at": _TIME, "_ingestion_date": _DATE, "order_date_year": _DATE,
    },
    required=("order_id",),
)
DAILY_REVENUE = _schema(
    {
        "order_date": _DATE, "region": _TEXT, "order_status": _TEXT, "total_orders": _LONG,
        "total_revenue": DecimalType(28, 2), "avg_order_value": DecimalType(22, 6), "order_date_year": _DATE,
    },
)
# The aggregate with what signed changes need: orders with an amount, orders at all, and the last load folded in.
DAILY_REVENUE_STATE = _schema(
    {
        "order_date": _DATE, "region": _TEXT, "order_status": _TEXT, "total_orders": _LONG,
        "total_revenue": DecimalType(28, 2), "priced_orders": _LONG, "order_rows": _LONG, "applied": _TEXT,
        "order_date_year": _DATE,
    },
)
ORDERS_SOURCE = _schema(
    {
        "order_id": _TEXT, "customer_id": _TEXT, "product_id": _TEXT, "order_amount": _MONEY,
        "order_status": _TEXT, "order_date": _DATE, "region": _TEXT, "updated_at": _TIME,
    },
)
CUSTOMERS_SILVER = _schema(
    {
        "customer_id": _TEXT, "customer_name": _TEXT, "city": _TEXT, "state": _TEXT, "customer_segment": _TEXT,
        "_silver_updated_date": _DATE,
    },
)
DIM_CUSTOMER = _schema(
    {
        "_scd_key": _TEXT, "customer_id": _TEXT, "customer_name": _TEXT, "city": _TEXT, "state": _TEXT,
        "customer_segment": _TEXT, "valid_from": _DATE, "valid_to": _DATE, "is_current": _BOOL,
        "_created_at": _TIME, "_updated_at": _TIME,
    },
    required=("_scd_key", "customer_id", "valid_from", "valid_to", "is_current"),
)
DQ_CHECK_LOG = _schema(
    {
        "check_id": _TEXT, "pipeline_name": _TEXT, "table_name": _TEXT, "check_name": _TEXT, "severity": _TEXT,
        "status": _TEXT, "expected_value": _TEXT, "actual_value": _TEXT, "message": _TEXT, "run_date": _DATE,
        "checked_at": _TIME,
    },
    required=("check_id",),
)
# The dimension as stored: one partition per year versions begin in.
DIM_CUSTOMER_STORED = StructType([*DIM_CUSTOMER.fields, StructField("valid_from_year", _DATE)])
# The dimension with its current versions apart: one partition per year versions end in.
DIM_CUSTOMER_APART = StructType([*DIM_CUSTOMER.fields, StructField("valid_to_year", _DATE)])
JOBS = _schema(
    {
        "job_id": _TEXT, "user_email": _TEXT, "total_bytes_processed": _LONG, "total_bytes_billed": _LONG,
        "total_slot_ms": _LONG, "creation_time": _TIME, "query": _TEXT, "job_type": _TEXT, "state": _TEXT,
    },
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in order and type; NULL in a NOT NULL column fails the job.

    The file source accepts NULLs in columns declared NOT NULL, so the test is part of the
    projection: no extra pass, and nothing is committed when it fails.
    """

    def column(field) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            stop = F.raise_error(F.lit(f"NULL in NOT NULL column {field.name}")).cast(field.dataType)
            value = F.coalesce(value, stop)
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    location: str,
    partition_by: tuple[str, ...] = (),
    description: str = "",
) -> None:
    """Register a Parquet table unless it exists."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    comment = description.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} "
        f"LOCATION '{location}' COMMENT '{comment}'"
    )
