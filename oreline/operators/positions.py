"""Global row numbers without sending all rows to one task.

A window without PARTITION BY, or with one huge partition, runs in a single task. Here the
rows are range-partitioned by the order instead, numbered inside each range, and each range
is shifted by the number of rows before it.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.scratch import written

# monotonically_increasing_id() keeps the partition number above this many bits.
_ROW_BITS = 33


@dataclass(frozen=True)
class Positioned:
    """Rows in a written table with their place in the order.

    ``starts`` has one entry per range, so at most as many as there are shuffle partitions.
    """

    table: DataFrame
    starts: tuple[tuple[int, int], ...]
    total: int

    def numbered(self, name: str = "position") -> DataFrame:
        """The rows with their 0-based position."""
        spark = self.table.sparkSession
        starts = spark.createDataFrame(list(self.starts), "_range int, _start bigint")
        in_range = F.col("_seq").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        ranged = self.table.withColumn("_range", F.shiftright("_seq", _ROW_BITS).cast("int"))
        return (
            ranged.join(F.broadcast(starts), "_range")
            .withColumn(name, F.col("_start") + in_range)
            .drop("_range", "_start", "_seq")
        )

    def at(self, positions: set[int]) -> DataFrame:
        """The rows at a few positions, found through the statistics of the sorted files."""
        firsts = [start for _, start in self.starts]
        wanted = []
        for position in positions:
            number, start = self.starts[bisect_right(firsts, position) - 1]
            wanted.append((number << _ROW_BITS) + position - start)
        return self.table.filter(F.col("_seq").isin(wanted)).drop("_seq")


def in_order(df: DataFrame, *order: Column | str, partitions: int | None = None) -> Positioned:
    """Number the rows of ``df`` by ``order``; rows that tie keep one arbitrary order.

    The rows are written first. Their place in the files is then a last order column that no
    two rows share, so any number of equal rows can be cut into ranges, and a task that runs
    again after the loss of an executor sees the same rows in the same order.
    """
    rows = written(df, "unordered").withColumn("_place", F.monotonically_increasing_id())
    ranges = (partitions,) if partitions else ()
    ranged = rows.repartitionByRange(*ranges, *order, "_place").sortWithinPartitions(*order, "_place")
    table = written(ranged.drop("_place").withColumn("_seq", F.monotonically_increasing_id()), "ordered")
    sizes = (
        table.groupBy(F.shiftright("_seq", _ROW_BITS).cast("int").alias("number")).count().orderBy("number").collect()
    )
    starts = [0, *accumulate(r["count"] for r in sizes)]
    return Positioned(table, tuple((r["number"], s) for r, s in zip(sizes, starts)), starts[-1])
