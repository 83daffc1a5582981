"""Top rows per group, deciles and percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreline.operators.positions import Positioned, in_order
from oreline.scratch import written


def _best_values(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """The values ranked 1..n in each group, with both ranks.

    A row ranks within n exactly when fewer than n rows of its group are larger, so the n
    first rows of a group, ties broken anyhow, already show every such value and all rows
    above it. Spark limits each group to n rows before the shuffle.
    """
    order = Window.partitionBy(group).orderBy(F.desc_nulls_last(value))
    first = (
        df.select(group, value)
        .withColumn("_row", F.row_number().over(order))
        .filter(F.col("_row") <= n)
    )
    ranked = first.withColumns({"_rank": F.rank().over(order), "_dense": F.dense_rank().over(order)})
    return ranked.filter(F.col("_rank") <= n).select(
        F.col(group).alias("_group"), F.col(value).alias("_value"), "_rank", "_dense"
    ).distinct()


def top_n_per_group(
    df: DataFrame, group: str, value: str, n: int, tie_break: str, suffix: str = "in_group"
) -> DataFrame:
    """Rows with RANK <= n in their group by ``value`` descending, with all three rankings.

    Ties at the last rank are all kept, however many they are. ROW_NUMBER follows ``tie_break``.
    """
    # At most n rows per group; written, so that Spark knows how few they are.
    best = written(_best_values(df, group, value, n), "best-values")
    kept = df.join(
        best, F.col(group).eqNullSafe(F.col("_group")) & F.col(value).eqNullSafe(F.col("_value"))
    ).drop("_group", "_value")
    order = (F.col(group), F.desc_nulls_last(value), F.col(tie_break))
    numbered = in_order(kept, *order).numbered()
    firsts = numbered.groupBy(F.col(group).alias("_group")).agg(F.min("position").alias("_first"))
    return (
        numbered.join(firsts, F.col(group).eqNullSafe(F.col("_group")))
        .withColumns(
            {
                f"rank_{suffix}": F.col("_rank"),
                f"dense_rank_{suffix}": F.col("_dense"),
                f"row_num_{suffix}": (F.col("position") - F.col("_first") + 1).cast("int"),
            }
        )
        .drop("_group", "_first", "_rank", "_dense", "position")
    )


def tile(position: Column, total: int, k: int) -> Column:
    """NTILE(k) of a 0-based position among ``total`` rows: the first tiles get the odd rows."""
    size, larger = divmod(total, k)
    in_larger = larger * (size + 1)
    wide = F.floor(position / F.lit(size + 1))
    narrow = F.lit(larger) + F.floor((position - in_larger) / F.lit(max(size, 1)))
    return (F.when(position < in_larger, wide).otherwise(narrow) + 1).cast("int")


def distributed_ntile(df: DataFrame, order: Sequence[Column | str], k: int, name: str = "tile") -> DataFrame:
    """NTILE(k) over the whole table in the given order."""
    ordered = in_order(df, *order)
    return ordered.numbered().withColumn(name, tile(F.col("position"), ordered.total, k)).drop("position")


def percentiles_of(ordered: Positioned, value: str, quantiles: Sequence[float]) -> list[float | None]:
    """Exact interpolated percentiles of rows ordered by ``value`` descending, NULLs last.

    Reads two rows per quantile from the ordered table.
    """
    count = ordered.table.select(F.count(value)).first()[0]
    if count == 0:
        return [None] * len(quantiles)
    # Position from the smallest value: whole part and fraction between two rows.
    places = [divmod(q * (count - 1), 1) for q in quantiles]
    below = [int(whole) for whole, _ in places]
    above = [min(i + 1, count - 1) for i in below]
    wanted = sorted({count - 1 - i for i in (*below, *above)})
    values = sorted(float(r[0]) for r in ordered.at(set(wanted)).select(value).collect())
    by_place = dict(zip(sorted(count - 1 - p for p in wanted), values))
    return [
        by_place[lo] + fraction * (by_place[hi] - by_place[lo])
        for lo, hi, (_, fraction) in zip(below, above, places)
    ]


def exact_percentiles(df: DataFrame, value: str, quantiles: Sequence[float]) -> list[float | None]:
    return percentiles_of(in_order(df.select(value), F.desc_nulls_last(value)), value, quantiles)


def approximate_percentiles(
    df: DataFrame, value: str, quantiles: Sequence[float], accuracy: int = 10_000
) -> list[float | None]:
    """Percentiles within a rank error of 1 / ``accuracy``, from one pass and without an order; opt-in."""
    row = df.agg(F.percentile_approx(F.col(value).cast("double"), list(quantiles), accuracy).alias("found")).first()
    return list(row.found) if row.found is not None else [None] * len(quantiles)


def total_spend(orders: DataFrame) -> DataFrame:
    """Completed spend per customer."""
    completed = orders.filter(F.col("order_status") == "COMPLETED")
    return completed.groupBy("customer_id").agg(F.sum("order_amount").alias("total_spend"))


def customer_segments(orders: DataFrame) -> DataFrame:
    """Spend decile (1 = highest), median, 90th percentile and tier of every customer.

    Deciles and percentiles share one ordered table.
    """
    ordered = in_order(total_spend(orders), F.desc_nulls_last("total_spend"), "customer_id")
    median, p90 = percentiles_of(ordered, "total_spend", (0.5, 0.9))
    decile = F.col("spend_decile")
    tier = (
        F.when(decile == 1, "PLATINUM").when(decile <= 3, "GOLD").when(decile <= 6, "SILVER").otherwise("BRONZE")
    )
    return (
        ordered.numbered()
        .withColumn("spend_decile", tile(F.col("position"), ordered.total, 10))
        .select(
            "customer_id",
            "total_spend",
            "spend_decile",
            F.lit(median).cast("double").alias("median_spend"),
            F.lit(p90).cast("double").alias("p90_spend"),
            tier.alias("customer_tier"),
        )
    )
