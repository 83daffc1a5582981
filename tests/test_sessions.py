import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from oreline.operators.sessions import session_summary, sessionize
from oreline.plans.explain import explained
from oreline.scratch import fresh_path
from oreline.sources import model

T0 = dt.datetime(2024, 1, 1, 0, 20)


def sessions(spark, seconds, **options):
    rows = [("u", T0 + dt.timedelta(seconds=s)) for s in seconds]
    df = spark.createDataFrame(rows, "user string, ts timestamp")
    found = sessionize(df, "user", "ts", **options).orderBy("ts").collect()
    return [r.session_no for r in found]


def test_a_pause_of_exactly_the_limit_stays(spark):
    assert sessions(spark, [0, 1800]) == [1, 1]
    assert sessions(spark, [0, 1801]) == [1, 2]


def test_sessions_run_across_slices(spark):
    steps = [i * 600 for i in range(12)]  # two hours without a pause
    assert sessions(spark, steps, slice_unit="HOUR") == [1] * 12
    assert sessions(spark, steps, slice_unit="MINUTE") == [1] * 12


def test_equal_times_share_a_session(spark):
    assert sessions(spark, [0, 0, 0, 4000, 4000]) == [1, 1, 1, 2, 2]


def test_missing_user_and_time(spark):
    rows = [(None, T0), (None, T0 + dt.timedelta(hours=5)), ("u", None)]
    df = spark.createDataFrame(rows, "user string, ts timestamp")
    got = {(r.user, r.ts): r.session_no for r in sessionize(df, "user", "ts").collect()}
    assert got == {(None, T0): 1, (None, T0 + dt.timedelta(hours=5)): 2, ("u", None): None}


def test_one_user_with_everything_equals_the_plain_window(spark):
    events = model.events(spark, "/root/testdata/sf0.01").withColumn("user_id", F.lit("u"))
    window = Window.partitionBy("user_id").orderBy("event_timestamp")
    gap = F.expr("INTERVAL 3 minutes")
    opens = F.when(F.col("event_timestamp") <= F.lag("event_timestamp").over(window) + gap, 0).otherwise(1)
    plain = events.withColumn("opens", opens).withColumn("session_no", F.sum("opens").over(window)).drop("opens")
    got = sessionize(events, "user_id", "event_timestamp", gap="3 minutes")
    assert got.select(*plain.columns).exceptAll(plain).isEmpty()
    summary = session_summary(got, "user_id", "event_timestamp")
    assert summary.agg(F.sum("events")).first()[0] == events.count()
    assert summary.count() == plain.agg(F.max("session_no")).first()[0] > 1


def test_the_times_are_scanned_once(spark):
    path = fresh_path(spark, "events")
    model.events(spark, "/root/testdata/sf0.001").write.parquet(path)
    numbered = sessionize(spark.read.parquet(path), "user_id", "event_timestamp")
    plan = explained(numbered, "simple")
    assert sum(path in line for line in plan.splitlines() if "FileScan" in line) == 1
