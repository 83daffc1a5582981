"""Small helpers the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.scratch import fresh_path

__all__ = ["bitmap_literal", "connected", "documents", "fresh_path", "frugal", "keep_rows", "numbered", "ship", "table", "test_bit", "texts", "with_rows", "written"]

#: A filter held in a literal has at most this many bits, whatever the data: 128 KB.
FILTER_BITS = 1 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package from wherever they were started.

    On a cluster the package comes with the job (``--py-files`` or an installed copy), like any other.
    """
    context = spark.sparkContext
    if context.master.startswith("local-cluster") or not context.master.startswith("local") or context.applicationId in _SHIPPED:
        return
    context.addFile(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), recursive=True)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """Only id and text, as ``doc_id`` and ``text``; a missing text is empty. Other columns cannot clash."""
    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), *more)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """Like ``documents`` with the text as UTF-8 bytes, the form numpy code takes."""
    rows = documents(docs, id_col, text_col, *more)
    return rows.withColumn("text", F.col("text").cast("binary"))


def numbered(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``docs`` written with a row number, so that repeated rows can be told apart; the number's column."""
    name = "__row"
    while name in docs.columns:
        name += "_"
    return written(docs.withColumn(name, F.monotonically_increasing_id()), label), name


def frugal(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for ``mapInArrow``, at the end of which the worker gives back the memory Arrow holds unused.

    Spark keeps Python workers for later tasks, and all of an executor's workers count against its memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()

    return run


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and return the table that was written.

    Lineage ends there, so a lost executor costs no more than its own tasks. Texts and packed
    strings make up most of such tables, hence the stronger compression.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_rows(docs: DataFrame, id_col: str, label: str) -> tuple[DataFrame, str]:
    """``docs`` and the column that tells its rows apart: the id, or a row number if ids repeat or are missing."""
    ids = docs.select(docs[id_col].alias("id")).groupBy("id").count()
    return (docs, id_col) if ids.where("count > 1 or id is null").isEmpty() else numbered(docs, label)


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is in the single column of ``kept``; a missing id matches a missing id."""
    ids = kept.toDF("__kept_id")
    return docs.join(ids, docs[id_col].cast("bigint").eqNullSafe(ids["__kept_id"]), "left_semi")


def bitmap_literal(hashes: DataFrame, bits: int = FILTER_BITS) -> Column:
    """Literal bitmap with the bit ``pmod(hash, bits)`` set for each value of the single column.

    The driver sees one number per 64 bits at most, so its size does not depend on the data.
    """
    slot = F.pmod(F.col(hashes.columns[0]), F.lit(bits))
    words = (
        hashes.select((slot / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod({hashes.columns[0]}, 64) as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()
    )
    out = ["0"] * ((bits + 63) // 64)
    for row in words:
        out[row.word] = str(row.bits)
    return F.split(F.lit(",".join(out)), ",").cast("array<bigint>")


def test_bit(bitmap: Column, hashed: Column, bits: int = FILTER_BITS) -> Column:
    slot = F.pmod(hashed, F.lit(bits))
    return F.getbit(F.get(bitmap, (slot / 64).cast("int")), F.pmod(slot, F.lit(64)).cast("int")) == 1


def connected(edges: DataFrame, label: str) -> DataFrame:
    """Smallest id reachable from each id of ``edges`` (columns ``a``, ``b``): columns ``id``, ``component``.

    Alternates large-star and small-star steps; each moves only rows of edges, ends after a number of
    rounds that grows with the logarithm of the longest path, and writes its edges, so lineage stays short.
    Neighbour minima are aggregates, so a vertex with very many neighbours is combined before the shuffle.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    if edges.isEmpty():
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("n")).select("a", F.least("a", "n").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, label)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        small = written(small, label)
        # A forest of stars: no id is both a child and a parent, and each child has one parent.
        parents = small.select("b").distinct()
        stars = small.join(parents.toDF("a"), "a", "left_semi").isEmpty() and small.groupBy("a").count().where("count > 1").isEmpty()
        edges = small
        if stars:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
