import datetime as dt
import os
import subprocess
import sys
import tempfile

from oreline.sources.jobs import expensive_jobs, jobs_from_event_logs
from oreline.sources.schemas import JOBS

SCRIPT = """
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "{logs}").getOrCreate())
spark.read.parquet("/root/testdata/sf0.001/orders.parquet").groupBy("o_orderstatus").count().collect()
spark.stop()
"""


def test_history_from_event_logs(spark):
    logs = tempfile.mkdtemp(prefix="run-")
    subprocess.run([sys.executable, "-c", SCRIPT.format(logs=logs)], check=True, timeout=180, capture_output=True)
    assert os.listdir(logs)
    jobs = jobs_from_event_logs(spark, logs)
    assert jobs.schema.fieldNames() == JOBS.fieldNames()
    rows = jobs.collect()
    assert rows and len({r.job_id for r in rows}) == len(rows)
    assert all(r.state == "DONE" and r.user_email for r in rows)
    assert any(r.total_bytes_processed > 0 and r.total_slot_ms > 0 for r in rows)
    report = expensive_jobs(jobs).collect()
    assert report and all(r.gb_billed is None for r in report)


def test_report_window_type_state_and_limit(spark):
    now = dt.datetime(2024, 1, 31)
    rows = [(str(i), "u", i * 1024**3, i * 1024**3, 1250, now, "q" * 200, "QUERY", "DONE") for i in range(1, 30)]
    rows += [
        ("edge", "u", 1024**4, 0, 0, now - dt.timedelta(days=7), "q", "QUERY", "DONE"),
        ("old", "u", 1024**4, 0, 0, now - dt.timedelta(days=7, seconds=1), "q", "QUERY", "DONE"),
        ("load", "u", 1024**4, 0, 0, now, "q", "LOAD", "DONE"),
        ("open", "u", 1024**4, 0, 0, now, "q", "QUERY", "RUNNING"),
    ]
    report = expensive_jobs(spark.createDataFrame(rows, JOBS), as_of=now).collect()
    assert [r.job_id for r in report] == ["edge", *[str(i) for i in range(29, 10, -1)]]
    assert report[1].gb_processed == 29.0 and float(report[1].slot_seconds) == 1.3
    assert len(report[1].query_preview) == 100
