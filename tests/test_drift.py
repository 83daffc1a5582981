"""Distributions of run dates against the one before."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from oreline.operators import drift
from oreline.plans.explain import explained


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "day string, x double, y int").withColumn("day", F.to_date("day"))


CUTS = {"x": [1.0, 2.0, 3.0], "y": [10.0]}


def plain(now, then, bins):
    cell = lambda side, b: (side.get(b, 0) + 0.5) / (sum(side.values()) + 0.5 * len(bins))
    psi = sum((cell(now, b) - cell(then, b)) * math.log(cell(now, b) / cell(then, b)) for b in bins)
    gap, ks = 0.0, 0.0
    for b in bins:
        gap += now.get(b, 0) / sum(now.values()) - then.get(b, 0) / sum(then.values())
        ks = max(ks, abs(gap))
    return round(psi, 6), round(ks, 6)


def test_index_and_distance(spark):
    days = {"2024-01-01": [0.5, 1.0, 1.5, 2.5, None], "2024-01-03": [3.0, 9.0, 3.5, None], "2024-01-04": [3.0, 9.0, 3.5, None]}
    df = table(spark, *[(d, x, 1) for d, values in days.items() for x in values], (None, 1.0, 1))
    got = {(str(r.run_date), r.column_name): r for r in drift.distribution_drift(drift.histograms(df, F.col("day"), CUTS), 4).collect()}
    place = lambda x: -1 if x is None else sum(c <= x for c in CUTS["x"])
    bins = {d: Counter(map(place, values)) for d, values in days.items()}
    assert len(got) == 6 and got["2024-01-01", "x"].psi is None and got["2024-01-01", "x"].rows_before is None
    for d, before in (("2024-01-03", "2024-01-01"), ("2024-01-04", "2024-01-03")):
        r = got[d, "x"]
        assert (r.rows, r.rows_before) == (len(days[d]), len(days[before]))
        assert all(abs(a - b) < 2e-6 for a, b in zip((r.psi, r.ks), plain(bins[d], bins[before], range(-1, 4))))
    assert got["2024-01-04", "x"].psi == 0 and got["2024-01-03", "y"].ks == 0


def test_histograms_add_up(spark):
    df = table(spark, *[("2024-01-01", float(i % 5), i) for i in range(50)])
    whole = drift.histograms(df, F.col("day"), CUTS)
    parts = [drift.histograms(df.filter(F.col("y") % 3 == k), F.col("day"), CUTS) for k in range(3)]
    assert sorted(map(tuple, drift.merged_histograms(*parts).collect())) == sorted(map(tuple, whole.collect()))
    plan = explained(drift.histograms(df, F.col("day"), CUTS))
    assert len(re.findall(r"^\(\d+\) (?:Scan|LocalTableScan)", plan, re.M)) == 1


def test_checks(spark):
    df = table(spark, *[("2024-01-01", 0.0, 1)] * 100, *[("2024-01-02", 0.0, 1)] * 50, *[("2024-01-03", 9.0, 1)] * 100)
    found = drift.distribution_drift(drift.histograms(df, F.col("day"), CUTS), 4)
    log = {(str(r.run_date), r.check_name): r for r in drift.drift_checks(found, "t", "p").collect()}
    assert log["2024-01-01", "x_distribution_drift"].status == log["2024-01-02", "x_distribution_drift"].status == "PASSED"
    failed = log["2024-01-03", "x_distribution_drift"]
    assert (failed.status, failed.severity) == ("FAILED", "WARNING") and "KS 1.0" in failed.message
    assert log["2024-01-03", "y_distribution_drift"].status == "PASSED"


def test_cuts(spark):
    df = spark.range(1000).select((F.col("id") / 10).alias("x"))
    cuts = drift.fit_cuts(df, "x", 4)
    assert cuts == [24.98, 49.95, 74.93] or all(abs(a - b) < 0.06 for a, b in zip(cuts, (25, 50, 75)))
    assert drift.fit_cuts(df.select(F.lit(1.0).alias("x")), "x", 4) == [1.0]
    assert drift.fit_cuts(df.filter("false"), "x", 4) == []
    empty = drift.histograms(table(spark), F.col("day"), CUTS)
    assert drift.distribution_drift(empty).collect() == []
