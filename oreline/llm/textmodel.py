"""Sparse text features and small models on them, fitted on a bounded sample of labelled rows.

A text's features are the distinct words in it (runs of letters, digits and bytes beyond ASCII, A-Z in
lower case), how these words begin (their first four and five bytes, so that forms of a word not in the
sample are known by their stem) and its distinct runs of punctuation. Which of them matter is read off the
sample by a chi-squared test, so a model is a table of at most ``max_features`` hashes with weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import texts, written

#: Labelled rows a model is fitted on, about (rows are drawn by a hash of their id).
SAMPLE_ROWS = 20_000
MAX_FEATURES = 256
STEMS = (4, 5)
#: Least chi-squared statistic of a feature: at a tenth of toxic texts, five of five that have it are toxic.
MIN_CHI2 = 40.0

_PUNCTUATION = ~tokens.ALNUM & tokens.NOT_SPACE
_PUNCTUATION[:33] = False


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and document of every word, word beginning and punctuation run of a chunk, and the words per document."""
    low = tokens.LOWER[data]
    starts, ends, bounds = tokens.spans(low, offsets, tokens.ALNUM)
    marks, mark_ends, mark_bounds = tokens.spans(low, offsets, _PUNCTUATION)
    n, hashes = len(offsets) - 1, tokens.slice_hasher(low)
    of = np.repeat(np.arange(n), np.diff(bounds))
    hashed, owner = [hashes(starts, ends), hashes(marks, mark_ends)], [of, np.repeat(np.arange(n), np.diff(mark_bounds))]
    for size in STEMS:
        longer = ends - starts > size
        hashed.append(hashes(starts[longer], starts[longer] + size) ^ np.uint64(0x5DEECE66D << size))
        owner.append(of[longer])
    return np.concatenate(hashed), np.concatenate(owner), np.diff(bounds)


def sample_features(docs: DataFrame, labelled: DataFrame, id_col: str, text_col: str, sample_rows: int, label: str) -> DataFrame:
    """``label, features`` of about ``sample_rows`` rows of ``labelled`` (``doc_id, label``) that have a document.

    Rows without id or label teach nothing; an id labelled twice differently counts with its largest label.
    """
    known = labelled.where("doc_id is not null and label is not null")
    share = min(1.0, sample_rows / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    drawn = written(drawn.groupBy("doc_id").agg(F.max("label").alias("label")), f"{label}-sample")
    # At most sample_rows ids and labels, whatever the size of the tables.
    rows = texts(docs, id_col, text_col).join(F.broadcast(drawn), "doc_id").select("label", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tokens.binary_column(batch, "text")
            found: list[np.ndarray] = []
            for first, last, part, own in tokens.chunks(data, offsets):
                hashed, owner, _ = features(part, own)
                order = np.lexsort((hashed, owner))
                hashed, owner = hashed[order], owner[order]
                new = np.ones(len(hashed), dtype=bool)
                new[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
                counts = np.bincount(owner[new], minlength=last - first)
                found.extend(np.split(hashed[new].view(np.int64), np.cumsum(counts)[:-1]))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.int64()))], ["label", "features"])

    return written(rows.select(F.col("label").cast("int"), "text").mapInArrow(extract, "label int, features array<bigint>"), f"{label}-features")


def choose_features(sample: DataFrame, classes: list[int], max_features: int, min_chi2: float) -> np.ndarray:
    """Hashes of the features that tell one class from the rest best, in order of hash."""
    sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    total = sum(sizes.values())
    seen = sample.select("label", F.explode("features").alias("f")).groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("label") == c).alias(f"n{c}") for c in classes]
    )
    best = F.lit(0.0)
    for c in classes:
        inside = float(sizes.get(c, 0))
        if 0 < inside < total:
            both = F.col(f"n{c}").cast("double")
            gap = both * total - F.col("n") * inside
            spread = F.col("n") * (total - F.col("n")) * inside * (total - inside)
            best = F.greatest(best, F.when(spread > 0, gap * gap * total / spread).otherwise(0.0))
    top = seen.select("f", best.alias("chi2")).where(F.col("chi2") >= min_chi2).orderBy(F.desc("chi2"), "f").limit(max_features)
    return np.sort(np.array([r.f for r in top.collect()], dtype=np.int64).view(np.uint64))


def design(sample: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """0/1 matrix and labels of the sample; only chosen features come to the driver."""
    spark = sample.sparkSession
    chosen = spark.createDataFrame([(int(v), i) for i, v in enumerate(vocabulary.view(np.int64))], "f bigint, at int")
    rows = (
        sample.withColumn("row", F.monotonically_increasing_id())
        .select("row", "label", F.explode_outer("features").alias("f"))
        .join(F.broadcast(chosen), "f", "left")
        .groupBy("row", "label")
        .agg(F.collect_list("at").alias("at"))
        .orderBy("row")
        .select("label", "at")
        .collect()
    )
    x = np.zeros((len(rows), len(vocabulary)), dtype=np.float32)
    for i, row in enumerate(rows):
        x[i, row.at] = 1
    return x, np.array([r.label for r in rows], dtype=np.int64)


def lookup(hashed: np.ndarray, owner: np.ndarray, vocabulary: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Sum of weight rows over the distinct known features of each of ``n`` documents."""
    out = np.zeros((n, weights.shape[1]))
    if not len(vocabulary) or not len(hashed):
        return out
    # Most words are unknown: a table on 16 bits of the hash drops nearly all before the search.
    gate = np.zeros(1 << 16, dtype=bool)
    gate[(vocabulary >> np.uint64(48)).astype(np.int64)] = True
    near = np.flatnonzero(gate[(hashed >> np.uint64(48)).astype(np.int64)])
    at = np.searchsorted(vocabulary, hashed[near])
    at[at == len(vocabulary)] = 0
    hit = vocabulary[at] == hashed[near]
    pairs = np.unique(owner[near][hit] * len(vocabulary) + at[hit])
    np.add.at(out, pairs // len(vocabulary), weights[pairs % len(vocabulary)])
    return out


def patterns(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows of a 0/1 matrix with their labels, and the share of the sample each stands for."""
    packed = np.concatenate([np.packbits(x.astype(bool), axis=1), y.astype(np.uint8)[:, None]], axis=1)
    _, first, counts = np.unique(packed, axis=0, return_index=True, return_counts=True)
    return x[first], y[first], counts / len(y)


def minimise(parameters: np.ndarray, gradient, steps: int = 600, rate: float = 0.1) -> np.ndarray:
    """Adam on the whole sample; the step shrinks to nothing, so runs end at the same place."""
    m = np.zeros_like(parameters)
    v = np.zeros_like(parameters)
    for t in range(1, steps + 1):
        g = gradient(parameters)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        parameters = parameters - rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return parameters


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class OrdinalModel:
    """Cumulative-link model: P(grade >= k) = logistic(score - threshold k), one weight per feature for all k."""

    vocabulary: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, score: np.ndarray) -> np.ndarray:
        return logistic(score[:, None] - self.thresholds[None, :])


def fit_ordinal(x: np.ndarray, y: np.ndarray, vocabulary: np.ndarray, grades: int, ridge: float = 1e-5) -> OrdinalModel:
    """Maximum likelihood of the cumulative-link model with a small ridge on the weights."""
    n, d = x.shape
    if n == 0 or grades < 2:
        return OrdinalModel(vocabulary, np.zeros((d, 1)), np.full(max(0, grades - 1), 30.0))
    share = np.array([(y >= k).sum() + 0.5 for k in range(1, grades)]) / (n + 1.0)
    x, y, share_of = patterns(x, y)
    start = np.maximum.accumulate(np.log((1 - share) / share) + np.arange(grades - 1) * 1e-3)
    steps = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])

    def thresholds(p: np.ndarray) -> np.ndarray:
        return p[0] + np.concatenate([[0.0], np.cumsum(np.exp(p[1:]))])

    def gradient(p: np.ndarray) -> np.ndarray:
        w, t = p[:d], thresholds(p[d:])
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        score = x @ w.astype(np.float32)
        upper, lower = logistic(edges[y + 1] - score), logistic(edges[y] - score)
        gap = np.maximum(upper - lower, 1e-9)
        g_w = x.T @ (share_of * (1 - upper - lower)).astype(np.float32) + ridge * w
        slope_upper, slope_lower = share_of * upper * (1 - upper) / gap, share_of * lower * (1 - lower) / gap
        g_t = np.array([slope_lower[y == k].sum() - slope_upper[y == k - 1].sum() for k in range(1, grades)])
        tail = np.cumsum(g_t[::-1])[::-1]
        return np.concatenate([g_w, tail[:1], tail[1:] * np.exp(p[d + 1 :])])

    p = minimise(np.concatenate([np.zeros(d), steps]), gradient)
    return OrdinalModel(vocabulary, p[:d, None], thresholds(p[d:]))


@dataclass(frozen=True)
class SoftmaxModel:
    """Class probabilities from the features and an intercept."""

    vocabulary: np.ndarray
    weights: np.ndarray
    intercept: np.ndarray

    def posteriors(self, score: np.ndarray) -> np.ndarray:
        z = score + self.intercept
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit_softmax(x: np.ndarray, y: np.ndarray, vocabulary: np.ndarray, classes: int, ridge: float = 1e-4) -> SoftmaxModel:
    n, d = x.shape
    share = (np.bincount(y, minlength=classes) + 0.5) / (n + 0.5 * classes)
    if n == 0:
        return SoftmaxModel(vocabulary, np.zeros((d, classes)), np.log(share))
    x, y, share_of = patterns(x, y)
    target = np.eye(classes)[y]

    def gradient(p: np.ndarray) -> np.ndarray:
        w, b = p[: d * classes].reshape(d, classes), p[d * classes :]
        z = x @ w.astype(np.float32) + b
        z = np.exp(z - z.max(axis=1, keepdims=True))
        off = share_of[:, None] * (z / z.sum(axis=1, keepdims=True) - target)
        return np.concatenate([(x.T @ off.astype(np.float32) + ridge * w).ravel(), off.sum(axis=0)])

    p = minimise(np.concatenate([np.zeros(d * classes), np.log(share)]), gradient)
    return SoftmaxModel(vocabulary, p[: d * classes].reshape(d, classes), p[d * classes :])
