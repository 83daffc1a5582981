"""Whether a column's values are distributed as they were on the run date before.

Every run date has a histogram on fixed cuts, counted in one scan. Histograms of parts of a date add up, so they
can be stored and extended by each load. Two dates are compared by the population stability index and by the
Kolmogorov-Smirnov distance of their histograms.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreline.functions.scalars import instant, text
from oreline.operators.quality import FAILED, PASSED, WARNING
from oreline.operators.ranking import exact_percentiles

BINS = 20
#: The index from which a population counts as shifted.
MAX_PSI = 0.25
#: Share of a row every bin is given, so that an empty bin has a logarithm.
SMOOTHING = 0.5
#: Bin of missing values; values below the first cut are in bin 0.
MISSING = -1


def fit_cuts(df: DataFrame, column: str, bins: int = BINS, decimals: int = 2) -> list[float]:
    """Values that part the column into bins of equal share, from its exact quantiles."""
    found = exact_percentiles(df, column, [i / bins for i in range(1, bins)])
    return sorted({round(v, decimals) for v in found if v is not None})


def histograms(df: DataFrame, run_date: Column, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """``run_date, column_name, bin, rows`` of every column in ``cuts``; counted in the map tasks first."""

    def place(column: str) -> Column:
        value, marks = F.col(column).cast("double"), F.array(*[F.lit(float(c)) for c in cuts[column]]).cast("array<double>")
        return F.when(value.isNull(), MISSING).otherwise(F.size(F.filter(marks, lambda c: c <= value)))

    places = F.array(*[F.struct(F.lit(c).alias("column_name"), place(c).alias("bin")) for c in cuts])
    return df.select(run_date.alias("run_date"), F.inline(places)).groupBy("run_date", "column_name", "bin").agg(F.count("*").alias("rows"))


def merged_histograms(*parts: DataFrame) -> DataFrame:
    """Histograms of several parts as one."""
    return reduce(DataFrame.unionByName, parts).groupBy("run_date", "column_name", "bin").agg(F.sum("rows").alias("rows"))


def distribution_drift(counts: DataFrame, bins: int = BINS) -> DataFrame:
    """``run_date, column_name, rows, rows_before, psi, ks`` against the run date before, NULL for the first one.

    Rows here are run dates; each has its histogram as one map of ``bins`` entries. Rows without a date are left out.
    """
    by_date = counts.filter(F.col("run_date").isNotNull()).groupBy("run_date", "column_name").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "rows"))).alias("now"), F.sum("rows").alias("rows")
    )
    before = Window.partitionBy("column_name").orderBy("run_date")
    pairs = by_date.withColumns({"then": F.lag("now").over(before), "rows_before": F.lag("rows").over(before)})
    every = range(MISSING, bins)
    held = lambda side, b: F.coalesce(F.try_element_at(side, F.lit(b)), F.lit(0)).cast("double")
    share = lambda side, rows, b: (held(side, b) + SMOOTHING) / (F.col(rows) + SMOOTHING * len(every))
    index, distance, gap = F.lit(0.0), F.lit(0.0), F.lit(0.0)
    for b in every:
        p, q = share("now", "rows", b), share("then", "rows_before", b)
        index = index + (p - q) * F.log(p / q)
        gap = gap + held("now", b) / F.col("rows") - held("then", b) / F.col("rows_before")
        distance = F.greatest(distance, F.abs(gap))
    known = F.col("rows_before").isNotNull()
    return pairs.select(
        "run_date", "column_name", "rows", "rows_before", F.when(known, F.round(index, 6)).alias("psi"), F.when(known, F.round(distance, 6)).alias("ks")
    )


def drift_checks(drift: DataFrame, table: str, pipeline: str, max_psi: float = MAX_PSI, now=None) -> DataFrame:
    """Drift as rows of the quality log: a warning where the index is above ``max_psi``; a first date passes."""
    said = F.concat(F.lit("PSI "), text(F.col("psi")), F.lit(" | KS "), text(F.col("ks")), F.lit(" | Rows: "), text(F.col("rows")), F.lit(" | Before: "), text(F.col("rows_before")))
    return drift.select(
        F.uuid().alias("check_id"),
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(table).alias("table_name"),
        F.concat("column_name", F.lit("_distribution_drift")).alias("check_name"),
        F.lit(WARNING).alias("severity"),
        F.when(F.col("psi").isNull() | (F.col("psi") <= max_psi), PASSED).otherwise(FAILED).alias("status"),
        F.lit(f"PSI <= {max_psi} vs the run date before").alias("expected_value"),
        F.concat(F.lit("PSI "), text(F.col("psi"))).alias("actual_value"),
        said.alias("message"),
        "run_date",
        instant(now).alias("checked_at"),
    )
