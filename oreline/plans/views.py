"""DuckDB text of the derived tables in ``sources.model``, written independently as SQL."""

GEO = "geo as (select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey)"

ORDERS_ALL = """orders_all as (
  select cast(o_orderkey as varchar) as order_id,
         cast(o_custkey as varchar) as customer_id,
         cast(o_orderkey % 200 as varchar) as product_id,
         cast(o_totalprice as decimal(18,2)) as order_amount,
         case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'PENDING' else 'CANCELLED' end as order_status,
         cast(o_orderdate as date) as order_date,
         r_name as region,
         o_orderpriority as product_category,
         o_orderdate + interval 30 day + to_seconds(o_custkey % 86400) as updated_at
  from orders join customer on o_custkey = c_custkey join geo on c_nationkey = n_nationkey
)"""

ORDERS = f"{GEO},\n{ORDERS_ALL}"

DAILY = f"""{ORDERS},
daily as (
  select order_date, region, sum(order_amount) as daily_revenue
  from orders_all where order_status = 'COMPLETED' group by order_date, region
)"""

SPEND = f"""{ORDERS},
spend as (
  select customer_id, sum(order_amount) as total_spend
  from orders_all where order_status = 'COMPLETED' group by customer_id
)"""

EVENTS = """events_all as (
  select cast(event_id as varchar) as event_id, event_type, cast(user_id as varchar) as user_id,
         props as event_payload, cast(ts as timestamp) as event_timestamp
  from events
)"""

WEB_ORDERS = f"""{GEO},
web_orders as (
  select cast(event_id as varchar) as order_id, cast(user_id as varchar) as customer_id,
         regexp_extract(props, ': ([0-9]+)', 1) as product_id, cast(value as decimal(18,2)) as order_amount,
         case event_type when 'purchase' then 'COMPLETED' when 'error' then 'CANCELLED' else 'PENDING' end
           as order_status,
         case when event_id % 97 = 0 then null when event_id % 89 = 0 then cast(ts as date) + 45
              else cast(ts as date) end as order_date,
         r_name as region, cast(ts as timestamp) as created_at
  from events left join customer on user_id = c_custkey left join geo on c_nationkey = n_nationkey
)"""

LOADED_UNTIL = "1998-01-01 00:00:00"
RUN_TS = "2001-12-31 00:00:00"

# Silver before the load, the changes to load, and Silver after it.
MERGED = f"""{ORDERS},
before as (
  select order_id, customer_id, product_id, order_amount,
         case when updated_at <= timestamp '{LOADED_UNTIL}' then order_status else 'PENDING' end as order_status,
         case when updated_at <= timestamp '{LOADED_UNTIL}' or cast(customer_id as bigint) % 5 > 1 then order_date
              when cast(customer_id as bigint) % 5 = 0 then order_date - 400 end as order_date,
         region, product_category,
         case when updated_at <= timestamp '{LOADED_UNTIL}' then updated_at
              else cast(order_date as timestamp) end as updated_at
  from orders_all where cast(order_date as timestamp) <= timestamp '{LOADED_UNTIL}'
),
batch as (
  select * exclude (product_category) from orders_all
  where updated_at > timestamp '{LOADED_UNTIL}' and updated_at <= timestamp '{RUN_TS}'
),
merged as (
  select coalesce(t.order_id, s.order_id) as order_id,
         case when s.order_id is null then t.customer_id else s.customer_id end as customer_id,
         case when s.order_id is null then t.product_id else s.product_id end as product_id,
         case when s.order_id is null then t.order_amount else s.order_amount end as order_amount,
         case when s.order_id is null then t.order_status else s.order_status end as order_status,
         case when s.order_id is null then t.order_date else s.order_date end as order_date,
         case when s.order_id is null then t.region else s.region end as region,
         t.product_category,
         case when s.order_id is null then t.updated_at else s.updated_at end as updated_at,
         case when s.order_id is null then date '1998-01-01' else date '2001-12-31' end as _ingestion_date
  from before t full outer join batch s on t.order_id = s.order_id
)"""

LINES = """lines as (
  select case when l_quantity = 50 and l_tax = 0.08 then null
              else cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) end as order_id,
         cast(l_extendedprice as decimal(18,2)) as order_amount,
         case when l_quantity = 1 and l_tax = 0 then 'REFUNDED'
              when l_returnflag = 'A' then 'COMPLETED'
              when l_returnflag = 'N' then 'PENDING' else 'CANCELLED' end as order_status,
         case when l_quantity = 49 and l_tax = 0.07 then null else cast(l_shipdate as date) end as _ingestion_date
  from lineitem
)"""

DAYS = f"""{LINES},
days as (
  select cast(d as date) as run_date
  from (select unnest(generate_series(cast(min(_ingestion_date) as timestamp), cast(max(_ingestion_date) as timestamp),
                                      interval 1 day)) as d from lines)
  union all
  select distinct _ingestion_date from lines where _ingestion_date is null
),
counted as (
  select _ingestion_date, count(*) as total_rows, count(distinct order_id) as unique_keys,
         count(*) - count(order_id) as null_count,
         count(*) filter (where order_status not in ('COMPLETED', 'PENDING', 'CANCELLED')) as bad_status
  from lines group by _ingestion_date
),
by_day as (
  select run_date, coalesce(t.total_rows, 0) as cnt, coalesce(t.unique_keys, 0) as unique_keys,
         coalesce(t.null_count, 0) as null_count, coalesce(t.bad_status, 0) as bad_status,
         coalesce(y.total_rows, 0) as yesterday_count,
         abs(coalesce(t.total_rows, 0) - coalesce(y.total_rows, 0)) / nullif(y.total_rows, 0) * 100 as pct_change
  from days left join counted t on t._ingestion_date is not distinct from run_date
            left join counted y on y._ingestion_date = run_date - 1
)"""


def _check(name: str, severity: str, passed: str, expected: str, actual: str, message: str) -> str:
    return (
        f"select 'orders_incremental' as pipeline_name, 'orders_silver' as table_name, '{name}' as check_name, "
        f"'{severity}' as severity, case when {passed} then 'PASSED' else 'FAILED' end as status, "
        f"'{expected}' as expected_value, {actual} as actual_value, {message} as message, run_date from by_day"
    )


CHECKS = {
    "dq_not_empty": _check(
        "not_empty", "CRITICAL", "cnt > 0", "> 0 rows", "cast(cnt as varchar)",
        "case when cnt > 0 then 'Row count: ' || cnt "
        "else 'CRITICAL: Table is empty — upstream pipeline likely failed' end",
    ),
    "dq_pk_not_null": _check(
        "order_id_not_null", "CRITICAL", "null_count = 0", "0 nulls", "null_count || ' nulls'",
        "'Null order_id count: ' || null_count",
    ),
    "dq_no_duplicates": _check(
        "no_duplicate_order_ids", "CRITICAL", "cnt = unique_keys", "0 duplicates",
        "(cnt - unique_keys) || ' duplicates'",
        "'Total: ' || cnt || ' | Unique keys: ' || unique_keys || ' | Duplicates: ' || (cnt - unique_keys)",
    ),
    "dq_row_count_drift": _check(
        "row_count_drift", "WARNING", "pct_change <= 30 or yesterday_count = 0", "<= 30% change vs yesterday",
        "round(pct_change, 1) || '% change'",
        "'Today: ' || cnt || ' | Yesterday: ' || yesterday_count || ' | Change: ' || round(pct_change, 1) || '%'",
    ),
    "dq_valid_values": _check(
        "order_status_valid_values", "WARNING", "bad_status = 0", "Only: COMPLETED, PENDING, CANCELLED",
        "bad_status || ' records with unexpected status'",
        "'Unexpected status count: ' || bad_status || ' — upstream system may have added a new status value'",
    ),
}

LOG = f"{DAYS},\nlog as ({' union all '.join(CHECKS.values())})"

VALIDATOR = {
    "validator_row_count": """select run_date, 'orders_silver.row_count' as check_name,
        case when cnt > 0 then 'PASSED' else 'FAILED' end as status, 'CRITICAL' as severity,
        cast(cnt as varchar) as actual, '> 0' as expected,
        'Row count for ' || run_date || ': ' || cnt as message from by_day""",
    "validator_pk_not_null": """select run_date, 'orders_silver.order_id_not_null' as check_name,
        case when null_count = 0 then 'PASSED' else 'FAILED' end as status, 'CRITICAL' as severity,
        null_count || ' nulls' as actual, '0 nulls' as expected,
        'Null order_id count: ' || null_count as message from by_day""",
    "validator_no_duplicates": """select run_date, 'orders_silver.order_id_no_duplicates' as check_name,
        case when cnt = unique_keys then 'PASSED' else 'FAILED' end as status, 'CRITICAL' as severity,
        (cnt - unique_keys) || ' duplicates' as actual, '0 duplicates' as expected,
        'Total: ' || cnt || ' | Unique: ' || unique_keys || ' | Dupes: ' || (cnt - unique_keys) as message
        from by_day""",
}

DIM_LOADED, FIRST_RUN, SECOND_RUN = "1995-01-01", "1997-06-01", "2000-01-01"

_HOME = "case when c_mktsegment = 'BUILDING' and c_acctbal < 5000 then (c_nationkey + 1) % 25 else c_nationkey end"


def _silver(run: str, name: str, touched: str) -> str:
    return f"""
  select cast(c_custkey as varchar) as customer_id, {name} as customer_name, n_name as city, r_name as state,
         case when c_acctbal < 0 then null else c_mktsegment end as customer_segment,
         {touched} as _silver_updated_date
  from customer join geo on n_nationkey = {_HOME}"""


SILVER_1 = _silver(
    FIRST_RUN, "c_name",
    f"case when c_mktsegment = 'FURNITURE' then date '{DIM_LOADED}' else date '{FIRST_RUN}' end",
)
SILVER_2 = _silver(
    SECOND_RUN, "case when c_acctbal > 8000 then c_name || ' II' else c_name end", f"date '{SECOND_RUN}'"
)


def _run(n: int, dim: str, silver: str, run: str, null_safe: bool = False) -> str:
    """MERGE, then INSERT of the new versions, each as one table."""
    columns = ("city", "state", "customer_name", "customer_segment")
    operator = "is distinct from" if null_safe else "!="
    changed = " or ".join(f"coalesce(t.{c} {operator} s.{c}, false)" for c in columns)
    return f"""
silver_{n} as ({silver}),
today_{n} as (select * from silver_{n} where _silver_updated_date = date '{run}'),
merged_{n} as (
  select t._scd_key, t.customer_id, t.customer_name, t.city, t.state, t.customer_segment, t.valid_from,
         case when s.customer_id is not null and ({changed}) then date '{run}' - 1 else t.valid_to end as valid_to,
         case when s.customer_id is not null and ({changed}) then false else t.is_current end as is_current,
         s.customer_id is not null and ({changed}) as was_closed
  from {dim} t left join today_{n} s on t.customer_id = s.customer_id and t.is_current
  union all
  select customer_id || '_{run}', customer_id, customer_name, city, state, customer_segment,
         date '{run}', date '9999-12-31', true, false
  from today_{n} s
  where not exists (select 1 from {dim} t where t.customer_id = s.customer_id and t.is_current)
),
dim_{n} as (
  select * exclude (was_closed) from merged_{n}
  union all
  select s.customer_id || '_{run}', s.customer_id, s.customer_name, s.city, s.state, s.customer_segment,
         date '{run}', date '9999-12-31', true
  from silver_{n} s join merged_{n} t on t.customer_id = s.customer_id and t.was_closed
)"""


DIM_0 = f"""{GEO},
dim_0 as (
  select cast(c_custkey as varchar) || '_{DIM_LOADED}' as _scd_key, cast(c_custkey as varchar) as customer_id,
         c_name as customer_name, n_name as city, r_name as state, c_mktsegment as customer_segment,
         date '{DIM_LOADED}' as valid_from, date '9999-12-31' as valid_to, true as is_current
  from customer join geo on n_nationkey = c_nationkey
  where c_mktsegment != 'MACHINERY'
)"""

DIM = f"{DIM_0},{_run(1, 'dim_0', SILVER_1, FIRST_RUN)},{_run(2, 'dim_1', SILVER_2, SECOND_RUN)}"
DIM_NULL_SAFE = f"{DIM_0},{_run(1, 'dim_0', SILVER_1, FIRST_RUN, null_safe=True)}"
# A second change on the date of the first: the dimension the integrity check must object to.
SILVER_AGAIN = _silver(
    FIRST_RUN, "case when c_acctbal > 8000 then c_name || ' II' else c_name end", f"date '{FIRST_RUN}'"
)
DIM_BROKEN = f"{DIM_0},{_run(1, 'dim_0', SILVER_1, FIRST_RUN)},{_run(2, 'dim_1', SILVER_AGAIN, FIRST_RUN)}"
