"""From raw documents to a mixed training corpus: five stages, each written as Parquet and read by the next.

A stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept. All but the last return the
columns of ``docs``; the last returns one row for each document that is left, with its sampling rate.
Missing texts count as empty: they are not toxic, one of them stays, they hold no benchmark item, and
they have no tokens. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oreline.llm import decontaminate, exact, mixing, near, toxicity
from oreline.llm.common import fresh_path, ship, table

#: Domains among documents that are not toxic, and the share of tokens each is to have.
DOMAINS = {"good": 0.95, "poor": 0.05}


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely toxic go; rows without text stay."""
    ship(spark)
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, toxicity.toxic_labels(table(spark, sf_dir, "labels"))))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a shingle similarity of 0.85 or more the row with the smallest id stays."""
    ship(spark)
    return near.drop_near(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also one with other numbers, names or units, go."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, p_good, p_poor, rate, target_met`` of every document left."""
    ship(spark)
    labels = mixing.quality_domains(table(spark, sf_dir, "labels")).where("label < 2")
    return mixing.mix(docs, mixing.fit_domains(docs, labels, len(DOMAINS)), DOMAINS)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_domains),
]

#: Models and similarity over whole texts are beyond SQL; the tests hold a run against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is left between two stages is a table in the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
