"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; the median is reported. Results go
to a sink that computes every row and column but stores nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oreline.plans.registry import QUERIES  # noqa: E402
from oreline.session import local_session  # noqa: E402

HEADLINE = (
    "top_n_per_group",
    "daily_revenue",
    "running_totals",
    "day_over_day",
    "date_gaps",
    "sessionize_events",
    "customer_tiers",
    "mv_daily_revenue_by_region",
    "mv_refresh_incremental",
    "cardinality_profile",
    "clustering_advice",
    "partition_by_date",
    "partition_by_int_range",
    "clustered_scan",
    "guarded_partition_scan",
    "partition_stats",
    "incremental_extract",
    "merge_upsert",
    "merge_latest_wins",
    "incremental_run",
    "reconciliation",
    "soft_delete",
    "scd2_merge",
    "scd2_as_of_inclusive",
    "scd2_version_counts",
    "scd2_asof_join",
    "scd2_integrity",
    "dq_no_duplicates",
    "dq_gate",
    "validator_no_duplicates",
    "expensive_jobs",
)


def seconds(query, spark, root: str) -> float:
    start = time.perf_counter()
    query(spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        query = QUERIES[name]
        seconds(query, spark, root)
        timings[name] = round(statistics.median(seconds(query, spark, root) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total median seconds of the headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
