"""Exact duplicates by progressive refinement, with DataFrame functions only.

Rows are told apart by length first, then by a hash of a prefix, then by a hash of the whole text.
What a step leaves over is passed on as a bitmap of fixed size held in the plan, not as a join, so
no text is ever shuffled. A full bitmap lets rows through that a later step separates; it never drops one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap_literal, documents, keep_rows, test_bit, with_rows, written

PREFIX_CHARS = 64


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, prefix_chars: int = PREFIX_CHARS, digest_all: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, row``.

    Texts are equal when identical; a missing text is empty. Of equal texts the row with the largest id
    stays (a missing id is smaller than any other); of repeated rows with that id, one stays.
    ``text_sha256`` is null for texts that an earlier step found to be unique, unless ``digest_all``.
    ``row`` is ``row_col`` or a number given here. Empty input gives no rows.
    """
    row = docs[row_col] if row_col else F.monotonically_increasing_id()
    rows = documents(docs, id_col, text_col, row.alias("row"))
    size = F.octet_length("text").alias("size")
    prefix = F.xxhash64(F.octet_length("text"), F.substring("text", 1, prefix_chars)).alias("prefix")
    keys = written(rows.select(size, prefix), "exact-keys")
    same_size = bitmap_literal(keys.groupBy("size").count().where("count > 1").select(F.xxhash64("size").alias("h")))
    same_prefix = bitmap_literal(
        keys.where(test_bit(same_size, F.xxhash64("size"))).groupBy("size", "prefix").count().where("count > 1").select("prefix")
    )
    open_ = test_bit(same_prefix, prefix)
    digest = F.sha2(F.col("text"), 256)
    full = written(
        rows.select(
            "doc_id",
            "row",
            open_.alias("open"),
            (digest if digest_all else F.when(open_, digest)).alias("text_sha256"),
        ),
        "exact-digests",
    )
    # Written, so that the join below is free to split a group that holds very many rows.
    groups = written(
        full.where("open")
        .groupBy("text_sha256")
        .agg(F.max(F.struct("doc_id", "row")).alias("top"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(F.col("text_sha256").alias("key"), "top", "group_size"),
        "exact-groups",
    )
    return full.join(groups, F.col("open") & (full.text_sha256 == groups.key), "left").select(
        full.doc_id,
        F.when(F.col("key").isNull(), full.doc_id).otherwise(F.col("top.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("key").isNull() | (F.col("top.row") == full.row)).alias("kept"),
        full.text_sha256,
        full.row,
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, one row of each group of equal texts, repeated rows included."""
    rows, number = with_rows(docs, id_col, "exact-rows")
    kept = exact_groups(rows, id_col, text_col, row_col=number).where("kept").select("row")
    return keep_rows(rows, kept, number).select(*docs.columns)


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest_all=True).drop("row")


OP10_SQL = """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
