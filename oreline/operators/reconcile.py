"""Which keys differ between two tables, found without moving the rows that agree.

Rows are summed up by hash bucket of their key, in any order: a count, an exclusive or and a sum of row hashes.
Buckets that agree are done. Those that do not are summed again in finer buckets, and only rows of unequal fine
buckets are brought together by key. The driver compares bucket sums, whose number is fixed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
FINE = 64


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row; a NULL is told apart from an empty value and from a NULL in another column."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def key_bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    """The bucket of a key; tables stored by it are read by bucket."""
    return F.pmod(row_hash(keys), F.lit(buckets)).cast("int")


def _fine(keys: Sequence[str], fine: int) -> Column:
    """A second bucket that does not depend on the first."""
    return F.pmod(F.xxhash64(row_hash(keys), F.lit(1)), F.lit(fine)).cast("int")


def bucket_sums(df: DataFrame, columns: Sequence[str], *buckets: Column) -> DataFrame:
    """Count, exclusive or and sum of row hashes per bucket; equal rows cancel in the second but not in the third."""
    hashed = df.select(*buckets, row_hash(columns).alias("_hash"))
    names = hashed.columns[:-1]
    return hashed.groupBy(*names).agg(
        F.count("*").alias("rows"), F.bit_xor("_hash").alias("mixed"), F.sum(F.col("_hash").cast("decimal(38,0)")).alias("summed")
    )


def _unequal(source: DataFrame, target: DataFrame, columns: Sequence[str], *buckets: Column) -> list[tuple]:
    """Buckets whose sums differ."""
    sums = [{tuple(r)[: len(buckets)]: tuple(r)[len(buckets) :] for r in bucket_sums(df, columns, *buckets).collect()} for df in (source, target)]
    return sorted(b for b in sums[0].keys() | sums[1].keys() if sums[0].get(b) != sums[1].get(b))


@dataclass(frozen=True)
class KeyReport:
    """Keys that differ, and how many buckets of each level had to be looked at."""

    keys: DataFrame
    unequal_buckets: list[int]
    unequal_fine: int


def reconcile_keys(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    stored_bucket: str | None = None,
    buckets: int = BUCKETS,
    fine: int = FINE,
) -> KeyReport:
    """``keys, status, differing_columns`` of every key that one table lacks or holds differently.

    ``status`` is ``missing`` (from the target), ``extra`` or ``differing``; ``columns`` are those compared. With
    ``stored_bucket``, a column of both tables that holds ``key_bucket(keys, buckets)`` and that they are
    partitioned by, only the unequal buckets' files are read again. A NULL in a key is a value like any other. A
    key with several rows on a side differs if their number or content does; it is reduced in the map tasks. The
    target's values are compared in the source's types.
    """
    compared = [c for c in columns if c not in keys]
    # Equal values of two types have two hashes.
    target = target.withColumns({c: F.col(c).cast(source.schema[c].dataType) for c in [*keys, *compared]})
    coarse = F.col(stored_bucket) if stored_bucket else key_bucket(keys, buckets)
    all_columns = [*keys, *compared]
    unequal = [b[0] for b in _unequal(source, target, all_columns, coarse.alias("b1"))]

    def again(df: DataFrame) -> DataFrame:
        return df.filter(coarse.isin(unequal)) if unequal else df.filter(F.lit(False))

    finer = _unequal(again(source), again(target), all_columns, coarse.alias("b1"), _fine(keys, fine).alias("b2")) if unequal else []
    numbers = [a * fine + b for a, b in finer]

    def sides(df: DataFrame, side: int) -> DataFrame:
        place = coarse * fine + _fine(keys, fine)
        rows = again(df).filter(place.isin(numbers) if numbers else F.lit(False))
        return rows.select(*keys, *compared, row_hash(all_columns).alias("_hash"), F.lit(side).alias("_side"))

    both = sides(source, 0).unionByName(sides(target, 1))
    here = lambda side, value: F.when(F.col("_side") == side, value)
    folded = both.groupBy(*keys).agg(
        *[F.count(here(s, F.lit(1))).alias(f"_rows{s}") for s in (0, 1)],
        *[F.sum(here(s, F.col("_hash").cast("decimal(38,0)"))).alias(f"_sum{s}") for s in (0, 1)],
        *[F.max(here(s, F.struct(F.col(c).alias("v")))).alias(f"_{c}{s}") for c in compared for s in (0, 1)],
    )
    status = (
        F.when(F.col("_rows1") == 0, "missing")
        .when(F.col("_rows0") == 0, "extra")
        .when((F.col("_rows0") != F.col("_rows1")) | (F.col("_sum0") != F.col("_sum1")), "differing")
    )
    differs = [F.when((F.col("_rows0") > 0) & (F.col("_rows1") > 0) & ~F.col(f"_{c}0").eqNullSafe(F.col(f"_{c}1")), F.lit(c)) for c in compared]
    found = folded.select(*keys, status.alias("status"), F.concat_ws(",", *differs).alias("differing_columns"))
    return KeyReport(found.filter(F.col("status").isNotNull()), unequal, len(finer))
