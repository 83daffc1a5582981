"""Toxicity severity by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textmodel as M
from . import tokens
from .common import table

#: A labelled toxic text with at least so many different telling words has grade 2, then 3.
GRADE_CUTS = (2, 4)
#: A document is toxic if grade 1 or more is at least this probable.
REJECT_AT = 0.5


def grade_labels(x: np.ndarray, y: np.ndarray, cuts: tuple[int, ...] = GRADE_CUTS) -> np.ndarray:
    """Ordered grades from 0/1 labels: a toxic text is graded by how many telling words it has."""
    if not len(y):
        return y
    toxic = y > 0
    telling = x[toxic].sum(axis=0) * max(1, (~toxic).sum()) > x[~toxic].sum(axis=0) * max(1, toxic.sum())
    hits = x[:, telling].sum(axis=1)
    return np.where(toxic, 1 + sum((hits >= c).astype(np.int64) for c in cuts), 0)


def fit_toxicity(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    grades: int | None = None,
    sample_rows: int = M.SAMPLE_ROWS,
    max_features: int = M.MAX_FEATURES,
    min_chi2: float = M.MIN_CHI2,
) -> M.OrdinalModel:
    """Model of the ``label`` column of ``labelled`` (``doc_id, label``), fitted on about ``sample_rows`` rows.

    With ``grades`` the labels are grades 0 to ``grades`` - 1; else they are 0 or 1 and toxic ones are graded
    by ``grade_labels``. Without any labelled document everything is graded 0.
    """
    sample = M.sample_features(docs, labelled, id_col, text_col, sample_rows, "toxicity")
    classes = list(range(grades)) if grades else [0, 1]
    vocabulary = M.choose_features(sample, classes, max_features, min_chi2)
    x, y = M.design(sample, vocabulary)
    if grades:
        return M.fit_ordinal(x, y, vocabulary, grades)
    return M.fit_ordinal(x, grade_labels(x, y), vocabulary, len(GRADE_CUTS) + 2)


def severity(text: Column, model: M.OrdinalModel, reject_at: float = REJECT_AT) -> Column:
    """Struct ``severity, p_toxic, grade, toxic`` of a text: expected grade, P(grade >= 1), likeliest grade.

    A missing or empty text has no features and gets the score of a text without telling words.
    """
    kind = pa.struct([("severity", pa.float64()), ("p_toxic", pa.float64()), ("grade", pa.int32()), ("toxic", pa.bool_())])

    def judge(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        data, offsets = tokens.binary_column(batch, "text")
        scores = np.zeros(len(column))
        for first, last, part, own in tokens.chunks(data, offsets):
            hashed, owner, _ = M.features(part, own)
            scores[first:last] = M.lookup(hashed, owner, model.vocabulary, model.weights, last - first)[:, 0]
        above = np.round(model.at_least(scores), 9)
        ladder = np.concatenate([np.ones((len(scores), 1)), above, np.zeros((len(scores), 1))], axis=1)
        grade = np.argmax(ladder[:, :-1] - ladder[:, 1:], axis=1).astype(np.int32)
        p_toxic = above[:, 0] if above.shape[1] else np.zeros(len(scores))
        return pa.StructArray.from_arrays(
            [pa.array(above.sum(axis=1)), pa.array(p_toxic), pa.array(grade), pa.array(p_toxic >= reject_at)], fields=list(kind)
        )

    verdict = F.arrow_udf(judge, "severity double, p_toxic double, grade int, toxic boolean")
    return verdict(F.coalesce(text, F.lit("")).cast("binary"))


def toxic_labels(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("label"))


def score_toxicity(docs: DataFrame, model: M.OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, severity, p_toxic, grade, toxic`` of every row, repeated rows and missing texts included."""
    return docs.select(docs[id_col].alias("doc_id"), severity(docs[text_col], model).alias("s")).select("doc_id", "s.*")


def drop_toxic(docs: DataFrame, model: M.OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns without the toxic rows."""
    return docs.where(~severity(docs[text_col], model)["toxic"])


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, toxic_labels(table(spark, sf_dir, "labels"))))
