"""Stupid-backoff scores of documents under n-gram counts of the whole corpus.

Texts are put into chunks of whole documents. Each chunk sends its distinct n-grams to the count table,
which is partitioned by n-gram hash; there all chunks' counts are added up, and the sums are joined to the
n-grams of every chunk that asked. Back at its chunk each word has the counts it needs and scores are
summed per document. N-grams travel packed (see ``packed``), so a shuffle moves a few bytes for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed, tokens
from .common import frugal, table, texts, written

ORDER = 2
BACKOFF = 0.4
#: N-grams of two or more words count as seen from so many occurrences on; one is the text's own.
MIN_COUNT = 2
#: Bytes of text in a chunk: the larger, the more often an n-gram comes again in its chunk and need not travel.
CHUNK_BYTES = 4 << 20
#: Bits of hash that tell n-grams apart; sorted differences of a chunk's keys then fit five bytes.
GRAM_BITS = 60
#: Bytes of a chunk whose words are hashed at once; hashing takes some 30 bytes for each.
HASH_BYTES = 1 << 20
#: Packed rows that a task turns into Python objects at once.
ROWS = 256


def _chunk_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``chunk, ids, ends, n_words, body``: whole documents, their bytes compressed together."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data, offsets = tokens.binary_column(batch, "text")
            for first, last, part, own in tokens.chunks(data, offsets, CHUNK_BYTES):
                n_words = int(tokens.spans(part, own, tokens.NOT_SPACE)[2][-1])
                ids = pa.ListArray.from_arrays(pa.array([0, last - first], pa.int32()), batch.column("doc_id").slice(first, last - first))
                ends = pa.array([own[1:].tolist()], pa.list_(pa.int64()))
                body = pa.array([squeeze.compress(part.tobytes())], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, ends, pa.array([n_words], pa.int64()), body], ["ids", "ends", "n_words", "body"])

    rows = texts(docs, id_col, text_col).mapInArrow(frugal(gather), "ids array<bigint>, ends array<bigint>, n_words bigint, body binary")
    return written(rows.select(F.monotonically_increasing_id().alias("chunk"), "ids", "ends", "n_words", "body"), "ngrams-chunks")


def _open(ends: pa.ListScalar, body: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a chunk and where each document's words begin."""
    raw = zstandard.ZstdDecompressor().decompress(body.as_py()) if body.as_py() else b""
    data = tokens.LOWER[np.frombuffer(raw, dtype=np.uint8)]
    own = np.concatenate([[0], ends.values.to_numpy()])
    words, bounds, n = [np.empty(0, np.uint64)], [np.zeros(1, np.int64)], 0
    for _, _, part, at in tokens.chunks(data, own, HASH_BYTES):
        starts, stops, begin = tokens.spans(part, at, tokens.NOT_SPACE)
        words.append(tokens.hash_slices(part, starts, stops))
        bounds.append(begin[1:] + n)
        n += len(starts)
    return np.concatenate(words), np.concatenate(bounds)


def _grams(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that stay in one document and the positions they begin at."""
    at = tokens.runs_inside(bounds, n)
    return (tokens.sequence_hashes(words, n)[at] ^ np.uint64(n)) >> np.uint64(64 - GRAM_BITS), at


def _demands(chunks: DataFrame, order: int, bits: int) -> DataFrame:
    """``range, n, chunk, grams, times``: distinct n-grams of every chunk in a key range, and their counts there."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, bounds = _open(batch.column("ends")[i], batch.column("body")[i])
                out: list[list] = [[], [], [], []]
                for n in range(1, order + 1):
                    grams, times = np.unique(_grams(words, bounds, n)[0], return_counts=True)
                    numbers, cuts = packed.slices(grams, bits, GRAM_BITS)
                    for number, a, b in zip(numbers.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                        for column, value in zip(out, (number, n, packed.pack(grams[a:b]), packed.pack_counts(times[a:b]))):
                            column.append(value)
                chunk = pa.array([batch.column("chunk")[i].as_py()] * len(out[0]), pa.int64())
                columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), chunk, pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["range", "n", "chunk", "grams", "times"])

    return chunks.select("chunk", "ends", "body").mapInArrow(frugal(split), "range bigint, n int, chunk bigint, grams binary, times binary")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[tuple]]]:
    """All rows of one range and n after the other; rows come sorted by them."""
    key, held = None, []
    for batch in batches:
        for part in (batch.slice(k, ROWS) for k in range(0, batch.num_rows, ROWS)):
            for row in zip(*(part.column(c).to_pylist() for c in ("range", "n", "chunk", "grams", "times"))):
                if row[:2] != key:
                    if held:
                        yield key, held
                    key, held = row[:2], []
                held.append(row[2:])
    if held:
        yield key, held


def _sum(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    grams = [packed.unpack(r[1]) for r in rows]
    times = np.concatenate([packed.unpack_counts(r[2]) for r in rows])
    keys, inverse = np.unique(np.concatenate(grams), return_inverse=True)
    return keys, np.bincount(inverse, weights=times).astype(np.int64), inverse, [len(g) for g in grams]


def _answers(demands: DataFrame) -> DataFrame:
    """``chunk, n, range, totals``: corpus counts of a chunk's n-grams in the order of the demand."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (number, n), rows in _ranges(batches):
            _, totals, inverse, sizes = _sum(rows)
            each = np.split(totals[inverse], np.cumsum(sizes)[:-1])
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([n] * len(rows), pa.int32()), pa.array([number] * len(rows), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([packed.pack_counts(x) for x in each], pa.binary())], ["chunk", "n", "range", "totals"])

    dealt = demands.repartition("range", "n").sortWithinPartitions("range", "n")
    return dealt.mapInArrow(frugal(answer), "chunk bigint, n int, range bigint, totals binary")


def ngram_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """The count tables: ``n, gram, count``, where ``gram`` is the 60-bit hash of an n-gram."""
    chunks = _chunk_table(docs, id_col, text_col)
    bits = packed.range_bits(chunks.agg(F.sum("n_words")).first()[0] or 0)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, n), rows in _ranges(batches):
            keys, totals, _, _ = _sum(rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), n, np.int32)), pa.array(keys.view(np.int64)), pa.array(totals)], ["n", "gram", "count"])

    return _demands(chunks, order, bits).repartition("range", "n").sortWithinPartitions("range", "n").mapInArrow(frugal(add), "n int, gram bigint, count bigint")


def backoff_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, backoff: float = BACKOFF, min_count: int = MIN_COUNT
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, log_score, mean_log_score``.

    Words lie between white space, A-Z in lower case. A word's score is count(n-gram) / count(the n-gram
    without its last word) for the longest n-gram up to ``order`` ending in it, within its document, that
    occurs ``min_count`` times; each step to a shorter one multiplies by ``backoff``. A word by itself scores
    its share of all words. ``log_score`` is the sum of natural logarithms. A text without words (missing and
    empty ones too) has 0 words, log score 0 and no mean; repeated rows are counted and scored each.
    """
    chunks = _chunk_table(docs, id_col, text_col)
    total = chunks.agg(F.sum("n_words")).first()[0] or 0
    bits = packed.range_bits(total)
    answers = _answers(_demands(chunks, order, bits)).groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("n", "range", "totals"))).alias("answers"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, bounds = _open(batch.column("ends")[i], batch.column("body")[i])
                answers = batch.column("answers")[i]
                by_order: list[list[bytes]] = [[] for _ in range(order + 1)]
                if answers.is_valid:
                    for n, totals in zip(answers.values.field(0).to_pylist(), answers.values.field(2).to_pylist()):
                        by_order[n].append(totals)
                best = np.zeros(len(words))
                before = np.full(len(words), total, dtype=np.int64)  # counts of the shorter n-gram by its first word
                for n in range(1, order + 1):
                    grams, at = _grams(words, bounds, n)
                    _, inverse = np.unique(grams, return_inverse=True)
                    counts = np.concatenate([np.empty(0, np.int64), *map(packed.unpack_counts, by_order[n])])[inverse]
                    word = at + n - 1
                    logs = np.log(counts / before[at])
                    if n == 1:
                        best = logs
                    else:
                        best[word] = np.where(counts >= min_count, logs, np.log(backoff) + best[word])
                    before = np.zeros(len(words), dtype=np.int64)
                    before[at] = counts
                n_words = np.diff(bounds)
                sums = np.array([best[a:b].sum() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())])
                mean = pa.array(sums / np.maximum(n_words, 1), mask=n_words == 0)
                ids = batch.column("ids")[i].values
                yield pa.RecordBatch.from_arrays([ids, pa.array(n_words.astype(np.int64)), pa.array(sums), mean], ["doc_id", "n_words", "log_score", "mean_log_score"])

    joined = chunks.select("chunk", "ids", "ends", "body").join(answers, "chunk", "left")
    return joined.select("ids", "ends", "body", "answers").mapInArrow(frugal(score), "doc_id bigint, n_words bigint, log_score double, mean_log_score double")


def op3_lm_scoring(spark, sf_dir: str) -> DataFrame:
    scores = backoff_scores(table(spark, sf_dir, "documents"))
    return scores.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


def op3_lm_scoring_trigrams(spark, sf_dir: str) -> DataFrame:
    scores = backoff_scores(table(spark, sf_dir, "documents"), order=3)
    return scores.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


OP3_SQL = """
WITH w AS (
  SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'),
         lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents),
t AS (SELECT doc_id, i, ws[i] AS word, CASE WHEN i > 1 THEN ws[i - 1] END AS prev
      FROM w, unnest(range(1, len(ws) + 1)) AS u(i)),
c1 AS (SELECT word, count(*) AS n FROM t GROUP BY word),
c2 AS (SELECT prev, word, count(*) AS n FROM t WHERE prev IS NOT NULL GROUP BY prev, word),
s AS (SELECT t.doc_id, CASE
        WHEN t.prev IS NULL THEN ln(c1.n / (SELECT count(*) FROM t))
        WHEN c2.n >= 2 THEN ln(c2.n / p.n)
        ELSE ln(0.4) + ln(c1.n / (SELECT count(*) FROM t)) END AS logs
      FROM t JOIN c1 ON t.word = c1.word LEFT JOIN c2 ON t.prev = c2.prev AND t.word = c2.word LEFT JOIN c1 p ON t.prev = p.word),
d AS (SELECT doc_id, count(*) AS n_words, sum(logs) AS log_score FROM s GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(log_score, 0), 4) AS log_score,
       round(log_score / n_words, 6) AS mean_log_score
FROM w LEFT JOIN d USING (doc_id)
"""

OP3_TRIGRAMS_SQL = """
WITH w AS (
  SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'),
         lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents),
t AS (SELECT doc_id, i, ws[i] AS word, CASE WHEN i > 1 THEN ws[i - 1] END AS prev, CASE WHEN i > 2 THEN ws[i - 2] END AS prev2
      FROM w, unnest(range(1, len(ws) + 1)) AS u(i)),
c1 AS (SELECT word, count(*) AS n FROM t GROUP BY word),
c2 AS (SELECT prev, word, count(*) AS n FROM t WHERE prev IS NOT NULL GROUP BY prev, word),
c3 AS (SELECT prev2, prev, word, count(*) AS n FROM t WHERE prev2 IS NOT NULL GROUP BY prev2, prev, word),
s AS (SELECT t.doc_id, CASE
        WHEN c3.n >= 2 THEN ln(c3.n / h.n)
        WHEN c2.n >= 2 THEN ln(c2.n / p.n) + CASE WHEN t.prev2 IS NULL THEN 0 ELSE ln(0.4) END
        ELSE ln(c1.n / (SELECT count(*) FROM t)) + CASE WHEN t.prev IS NULL THEN 0 WHEN t.prev2 IS NULL THEN ln(0.4) ELSE 2 * ln(0.4) END END AS logs
      FROM t JOIN c1 ON t.word = c1.word LEFT JOIN c2 ON t.prev = c2.prev AND t.word = c2.word LEFT JOIN c1 p ON t.prev = p.word
      LEFT JOIN c3 ON t.prev2 = c3.prev2 AND t.prev = c3.prev AND t.word = c3.word LEFT JOIN c2 h ON t.prev2 = h.prev AND t.prev = h.word),
d AS (SELECT doc_id, count(*) AS n_words, sum(logs) AS log_score FROM s GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(log_score, 0), 4) AS log_score,
       round(log_score / n_words, 6) AS mean_log_score
FROM w LEFT JOIN d USING (doc_id)
"""
