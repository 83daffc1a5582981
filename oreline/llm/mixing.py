"""Document rates that bring a corpus to target domain weights.

A classifier fitted on a labelled table gives every document a probability for each domain. Rates r >= 0
then minimise the squared distance between expected domain token totals, the sum over documents of
rate * tokens * probability, and their targets. Projected gradient steps run over all documents on Spark:
a step needs one sum per domain and one per pair of domains, and the driver sees nothing else. The step is scaled by
what the documents that can still move have in common, so it does not slow down where rates end at zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textmodel as M
from . import tokens
from .common import table, texts, written

#: Domains of the registered query and the share of the tokens each is to have.
DOMAINS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}
#: Expected tokens after mixing, as a share of the corpus.
BUDGET = 0.5
MAX_STEPS = 60
TOLERANCE = 1e-4


def fit_domains(
    docs: DataFrame,
    labelled: DataFrame,
    domains: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = M.SAMPLE_ROWS,
    max_features: int = M.MAX_FEATURES,
    min_chi2: float = M.MIN_CHI2,
) -> M.SoftmaxModel:
    """Softmax model of ``label`` (0 to ``domains`` - 1) on about ``sample_rows`` rows of ``labelled``."""
    sample = M.sample_features(docs, labelled.where(f"label >= 0 and label < {domains}"), id_col, text_col, sample_rows, "domains")
    vocabulary = M.choose_features(sample, list(range(domains)), max_features, min_chi2)
    x, y = M.design(sample, vocabulary)
    return M.fit_softmax(x, y, vocabulary, domains)


def posteriors(docs: DataFrame, model: M.SoftmaxModel, names: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, p_<name>...`` of every row. A text without known features gets the model's intercept."""
    fields = ", ".join(f"p{i} double" for i in range(len(names)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tokens.binary_column(batch, "text")
            p = np.zeros((batch.num_rows, len(names)))
            n = np.zeros(batch.num_rows, dtype=np.int64)
            for first, last, part, own in tokens.chunks(data, offsets):
                hashed, owner, n[first:last] = M.features(part, own)
                p[first:last] = model.posteriors(M.lookup(hashed, owner, model.vocabulary, model.weights, last - first))
            columns = [batch.column("doc_id"), pa.array(n), *(pa.array(np.ascontiguousarray(p[:, i])) for i in range(len(names)))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", *(f"p{i}" for i in range(len(names)))])

    out = texts(docs, id_col, text_col).mapInArrow(judge, f"doc_id bigint, n_tokens bigint, {fields}")
    return out.toDF("doc_id", "n_tokens", *(f"p_{name}" for name in names))


@dataclass(frozen=True)
class Mixed:
    """Documents with their rates, what share of the corpus each domain reaches, and whether that is the target."""

    rates: DataFrame
    reached: dict[str, float]
    met: bool
    steps: int


def solve_rates(
    shares: DataFrame, weights: dict[str, float], budget: float = BUDGET, max_steps: int = MAX_STEPS, tolerance: float = TOLERANCE
) -> Mixed:
    """``shares`` (``n_tokens``, ``p_<name>`` for each domain) with a column ``rate`` >= 0.

    The target of domain k is ``weights[k] / sum(weights) * budget`` of all tokens. Every rate starts at ``budget``.
    Steps go down the gradient, scaled by the inverse of the tokens that domains have in common in documents whose
    rate is above zero; a rate is the start less all steps so far, and zero where that is below. So the state of the
    fit is one number per domain, and no rates are stored in between. A step that brings the totals no nearer is
    taken again at half its length. Ends when all totals are within ``tolerance`` of the target total. A target out
    of reach, such as that of a domain no document belongs to, ends after ``max_steps`` or when no step helps, with
    ``met`` false and the totals reached. No tokens at all: rates stay at ``budget``.
    """
    names = list(weights)
    p = [F.col(f"p_{name}") for name in names]
    target = np.array([weights[n] for n in names]) / sum(weights.values()) * budget
    tokens_ = F.col("n_tokens").cast("double")

    def rated(steps_: np.ndarray) -> DataFrame:
        less = sum((q * float(x) for q, x in zip(p, steps_)), F.lit(0.0))
        return shares.withColumn("rate", F.greatest(F.lit(0.0), F.lit(float(budget)) - less))

    def sums(steps_: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """All tokens, and as shares of them the domains' totals and their common tokens where rates are above zero."""
        found = rated(steps_).agg(
            F.sum(tokens_).alias("n"),
            *[F.sum(tokens_ * F.col("rate") * q).alias(f"s{i}") for i, q in enumerate(p)],
            *[F.sum(F.when(F.col("rate") > 0, tokens_ * p[i] * p[j]).otherwise(0.0)).alias(f"m{i}_{j}") for i in range(len(p)) for j in range(i + 1)],
        ).first()
        n = float(found.n or 0)
        common = np.zeros((len(p), len(p)))
        for i in range(len(p)):
            for j in range(i + 1):
                common[i, j] = common[j, i] = found[f"m{i}_{j}"] or 0.0
        return n, np.array([found[f"s{i}"] or 0.0 for i in range(len(p))]) / max(n, 1.0), common / max(n, 1.0)

    sum_of_steps = np.zeros(len(p))
    n, total, common = sums(sum_of_steps)
    if not n:
        return Mixed(rated(sum_of_steps), dict.fromkeys(names, 0.0), True, 0)
    # A domain without a token stays short; it does not keep the others from their targets.
    use = np.diag(common) > 0
    steps, length, error = 0, 1.0, float(np.abs(total - target)[use].max(initial=0.0))
    while error > tolerance * budget and steps < max_steps and length > 1e-3:
        steps += 1
        # The ridge keeps a step finite where two domains share all their documents.
        scaled = common + 1e-9 * np.trace(common) * np.eye(len(p)) + np.diag(np.where(use, 0.0, 1.0))
        step = np.linalg.solve(scaled, np.where(use, total - target, 0.0)) * length
        _, now, shared = sums(sum_of_steps + step)
        off = float(np.abs(now - target)[use].max())
        if off < error and np.trace(shared) > 0:
            sum_of_steps, total, common, error, length = sum_of_steps + step, now, shared, off, min(1.0, 2 * length)
        else:
            length /= 2
    met = bool(error <= tolerance * budget and use.all())
    # Sums of doubles depend on the order of rows in their last digits.
    return Mixed(rated(sum_of_steps).withColumn("rate", F.round("rate", 6)), dict(zip(names, total.tolist())), met, steps)


def mix(
    docs: DataFrame, model: M.SoftmaxModel, weights: dict[str, float], budget: float = BUDGET, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, p_<name>..., rate, target_met`` of every row of ``docs``; the last is the same for all."""
    shares = written(posteriors(docs, model, list(weights), id_col, text_col), "mixing-posteriors")
    mixed = solve_rates(shares, weights, budget)
    return mixed.rates.withColumn("target_met", F.lit(mixed.met))


def quality_domains(labels: DataFrame) -> DataFrame:
    """Domains of the labelled table: 0 good, 1 poor, 2 toxic."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)
    return labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), domain.alias("label"))


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_domains(docs, quality_domains(table(spark, sf_dir, "labels")), len(DOMAINS))
    return mix(docs, model, DOMAINS)
