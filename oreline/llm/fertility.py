"""Quality rules by tokeniser fertility, operator 11.

Public vocabularies say how text-like a text is: characters a token, share of tokens that spell single bytes,
and entropy of its tokens. Text of a language lies in a narrow range of each; keys, tables, encodings and
repetition lie outside. Bands come from the corpus itself, for each language, or for the script where a
language has few texts.

Null texts have no words, no tokens and no measures, and fail the base rule. Rows that repeat an id or have
none are judged each by itself; equal texts get equal measures. An empty table gives an empty result. Extra
columns are not read. A very long text is one unit of work, whole.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep_rows, table, texts, with_rows, written
from .tokens import NOT_SPACE, binary_column, chunks, runs_inside, sequence_hashes, slice_hasher, spans

TOKENIZERS = "/opt/tokenizers"
#: Measures characters a token and entropy.
BYTE_LEVEL = "byte_bpe_multi_50k.tiktoken"
#: Measures the share of byte tokens: it falls back to bytes for characters it does not know.
FALLBACK = "piece_bpe_32k.model"
#: How byte-level vocabularies of this kind cut text before they merge; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
MIN_WORDS = 50
MAX_REPEATED = 50
WINDOW = 3

#: Scripts by the first byte of a character in UTF-8, in order of the table below.
SCRIPTS = ("latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "cjk", "hangul", "other")
_SCRIPT = np.full(256, -1, dtype=np.int8)
for _name, _bytes in {
    "latin": (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)),
    "greek": (0xCD, 0xCE, 0xCF),
    "cyrillic": range(0xD0, 0xD5),
    "hebrew": (0xD6, 0xD7),
    "arabic": range(0xD8, 0xDC),
    "indic": (0xE0,),
    "cjk": range(0xE3, 0xEA),
    "hangul": range(0xEA, 0xEE),
    "other": (0xCA, 0xCB, 0xCC, 0xDC, 0xDD, 0xDE, 0xDF, 0xE1, 0xE2, 0xEE, 0xEF, *range(0xF0, 0xF5)),
}.items():
    _SCRIPT[list(_bytes)] = SCRIPTS.index(_name)

MEASURES = ("chars_per_token", "byte_share", "token_entropy")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_pieces", "n_byte_pieces")


@dataclass(frozen=True)
class Vocabularies:
    """Contents of two vocabulary files: half a megabyte to two, whatever the corpus, so they travel with the task."""

    byte_level: bytes
    fallback: bytes


def read_vocabularies(folder: str = TOKENIZERS, byte_level: str = BYTE_LEVEL, fallback: str = FALLBACK) -> Vocabularies:
    """Read the files once, on the driver; workers need no copy of the folder."""
    with open(f"{folder}/{byte_level}", "rb") as one, open(f"{folder}/{fallback}", "rb") as two:
        return Vocabularies(one.read(), two.read())


Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter((i for word in ids for i in word), np.int64, int(sizes.sum())), sizes


@lru_cache(maxsize=2)
def encoders(files: Vocabularies) -> tuple[Encoder, Encoder, np.ndarray]:
    """Two functions from words to token ids and tokens a word, and which ids of the second spell a byte."""
    import sentencepiece
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, files.byte_level.splitlines())}
    byte_level = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_proto=files.fallback)
    spells = np.array([pieces.is_byte(i) for i in range(pieces.get_piece_size())], dtype=bool)
    return (
        lambda words: _flat([byte_level.encode_ordinary(" " + w) for w in words]),
        lambda words: _flat(pieces.encode(words, num_threads=1)),
        spells,
    )


def _doc_counts(docs: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(docs, weights=values, minlength=n).astype(np.int64)


def _repeats(docs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each pair, in the order given, whether an equal one lies before it."""
    order = np.lexsort((hashes, docs))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (docs[order][1:] == docs[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    out = np.empty(len(order), dtype=bool)
    out[order] = same
    return out


def _dup_lines(data: np.ndarray, offsets: np.ndarray, hashes, in_word: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, for each text."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    docs = np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, side="right") - 1])
    docs.sort()
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - (docs[1:] == docs[:-1])
    ends[-1:] = offsets[-1]
    words = np.concatenate([[0], np.cumsum(in_word[data])])
    real = words[ends] > words[starts]
    again = _repeats(docs[real], hashes(starts[real], ends[real]))
    return np.bincount(docs[real], weights=again, minlength=n).astype(np.int64)


def _repeat_words(words: np.ndarray, bounds: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Words in windows of three that their text has twice or more, for each text."""
    at = runs_inside(bounds, WINDOW)
    if not len(at):
        return np.zeros(len(bounds) - 1, np.int64)
    hashes, owner = sequence_hashes(words, WINDOW)[at], docs[at]
    order = np.lexsort((hashes, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    several = np.zeros(len(at), dtype=bool)
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(WINDOW):
        covered[at[several] + shift] = True
    return _doc_counts(docs, covered, len(bounds) - 1)


def _entropy(owner: np.ndarray, tokens: np.ndarray, times: np.ndarray, n: int) -> np.ndarray:
    """Bits a token of each text's tokens, where token ``tokens[i]`` is ``times[i]`` times in text ``owner[i]``."""
    out = np.zeros(n)
    if not len(owner):
        return out
    order = np.lexsort((tokens, owner))
    owner, tokens, times = owner[order], tokens[order], times[order]
    first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (tokens[1:] != tokens[:-1])))
    count = np.add.reduceat(times, first).astype(np.float64)
    total = np.bincount(owner[first], weights=count, minlength=n)
    inner = np.bincount(owner[first], weights=count * np.log2(count), minlength=n)
    some = total > 0
    out[some] = np.maximum(0.0, np.log2(total[some]) - inner[some] / total[some])
    return out


def measure(data: np.ndarray, offsets: np.ndarray, files: Vocabularies) -> dict[str, np.ndarray]:
    """Counts and measures of a run of whole texts; words are encoded once for all texts of the run."""
    byte_level, fallback, spells = encoders(files)
    n = len(offsets) - 1
    starts, ends, bounds = spans(data, offsets, NOT_SPACE)
    docs = np.repeat(np.arange(n), np.diff(bounds))
    hashes = slice_hasher(data)
    words = hashes(starts, ends)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
    out = {
        "n_words": np.diff(bounds),
        "word_chars": _doc_counts(docs, points[ends] - points[starts], n),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": _dup_lines(data, offsets, hashes, NOT_SPACE),
        "n_repeat_words": _repeat_words(words, bounds, docs),
    }
    scripts = _SCRIPT[data]
    there = np.flatnonzero(scripts >= 0)
    texts_of = np.searchsorted(offsets, there, side="right") - 1
    letters = np.bincount(texts_of * len(SCRIPTS) + scripts[there], minlength=n * len(SCRIPTS)).reshape(n, -1)
    out["script"] = np.where(letters.sum(axis=1) > 0, letters.argmax(axis=1), SCRIPTS.index("other"))

    _, first, which = np.unique(words, return_index=True, return_inverse=True)
    raw = data.tobytes()
    distinct = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    # Each text's words once, with their number.
    pairs, times = np.unique(docs * max(1, len(first)) + which, return_counts=True)
    owner, word = pairs // max(1, len(first)), pairs % max(1, len(first))
    ids, sizes = fallback(distinct)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    spelt = np.concatenate([[0], np.cumsum(spells[ids])])
    out["n_pieces"] = _doc_counts(owner, sizes[word] * times, n)
    out["n_byte_pieces"] = _doc_counts(owner, (spelt[upto[1:]] - spelt[upto[:-1]])[word] * times, n)
    ids, sizes = byte_level(distinct)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    out["n_tokens"] = _doc_counts(owner, sizes[word] * times, n)
    long = sizes[word]
    place = np.repeat(upto[word] - np.concatenate([[0], np.cumsum(long)[:-1]]), long) + np.arange(int(long.sum())) if len(long) else np.empty(0, np.int64)
    out["token_entropy"] = _entropy(np.repeat(owner, long), ids[place], np.repeat(times, long), n)
    return out


def _measured(files: Vocabularies, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary_column(batch, "text")
            for a, b, part, at in chunks(data, offsets):
                found = measure(part, at, files)
                columns = [batch.column(batch.schema.get_field_index(c)).slice(a, b - a) for c in keep]
                columns += [pa.array(found[c].astype(np.int64)) for c in COUNTS]
                columns += [pa.array(found["token_entropy"]), pa.array([SCRIPTS[i] for i in found["script"]], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *COUNTS, "token_entropy", "script"])

    return run


def measures(docs: DataFrame, files: Vocabularies, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row for each text: the counts, its script, and the three measures (null without tokens)."""
    rows = texts(docs, id_col, text_col, docs[lang_col].cast("string").alias("lang"))
    schema = "doc_id bigint, lang string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", token_entropy double, script string"
    found = rows.mapInArrow(_measured(files, ["doc_id", "lang"]), schema)
    some = F.col("n_tokens") > 0
    return found.withColumns(
        {
            "chars_per_token": F.when(some, F.col("word_chars") / F.col("n_tokens")),
            "byte_share": F.when(F.col("n_pieces") > 0, F.col("n_byte_pieces") / F.col("n_pieces")),
            "token_entropy": F.when(some, F.col("token_entropy")),
        }
    )


#: Width of a bin, so that quartiles are exact over a bounded number of values, and the least spread of a measure.
BINS = {"chars_per_token": 0.01, "byte_share": 0.005, "token_entropy": 0.02}
LEAST_SPREAD = {"chars_per_token": 0.04, "byte_share": 0.02, "token_entropy": 0.2}
#: A band reaches so many quartile distances beyond the quartiles.
REACH = 5.0
#: Texts a language or a script must have for a band of its own.
MIN_TEXTS = 100
#: Bands for texts whose script has too few texts as well: what any writing system stays within.
ANY_SCRIPT = {"chars_per_token": (0.25, 12.0), "byte_share": (0.0, 0.5), "token_entropy": (2.0, 14.0)}


def fit_bands(measured: DataFrame, reach: float = REACH, min_texts: int = MIN_TEXTS, min_words: int = MIN_WORDS) -> DataFrame:
    """Bands of each language and each script with enough texts: ``scope, name, low_<measure>, high_<measure>``.

    Every text of ``min_words`` words or more counts. Values are counted by bin in the map tasks, so a language
    with most of the texts weighs no more than its bins, and the quartiles of the bins are exact.
    """
    long = measured.where((F.col("n_words") >= min_words) & (F.col("n_tokens") > 0))
    values = [F.struct(F.lit(m).alias("measure"), F.floor(F.col(m) / F.lit(w)).alias("bin")) for m, w in BINS.items()]
    scopes = [F.struct(F.lit(s).alias("scope"), F.col(s).alias("name")) for s in ("lang", "script")]
    binned = long.select(F.explode(F.array(*scopes)).alias("of"), F.array(*values).alias("values")).select("of", F.explode("values").alias("v"))
    counted = binned.where("of.name is not null").groupBy("of", "v").agg(F.count("*").alias("n"))
    quartiles = counted.groupBy("of", "v.measure").agg(F.sum("n").alias("n"), F.percentile("v.bin", [0.25, 0.75], F.col("n")).alias("q"))
    wide = quartiles.groupBy("of").agg(F.max("n").alias("n"), *[F.max(F.when(F.col("measure") == m, F.col("q"))).alias(m) for m in MEASURES])

    def limit(measure: str, side: int) -> Column:
        low, high = F.get(measure, F.lit(0)) * BINS[measure], (F.get(measure, F.lit(1)) + 1) * BINS[measure]
        spread = F.greatest(high - low, F.lit(LEAST_SPREAD[measure])) * reach
        return (high + spread if side else low - spread).alias(f"{'high' if side else 'low'}_{measure}")

    limits = [limit(m, side) for m in MEASURES for side in (0, 1)]
    return wide.where(F.col("n") >= min_texts).select("of.scope", "of.name", *limits)


def judge(measured: DataFrame, bands: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed``, ``band`` (what it was judged by), ``outside`` (measures beyond it) and ``kept``.

    Texts whose language has no band, or that have none, are judged by their script, else by limits that hold
    for any script. A text without tokens has no measures and is outside nothing.
    """
    limits = [f"{side}_{m}" for m in MEASURES for side in ("low", "high")]
    of = lambda scope: bands.where(F.col("scope") == scope).select(F.col("name").alias(scope), F.struct(*limits).alias(f"_{scope}"))
    fixed = F.struct(*[F.lit(ANY_SCRIPT[m][side]).alias(f"{'high' if side else 'low'}_{m}") for m in MEASURES for side in (0, 1)])
    rows = measured.join(of("lang"), "lang", "left").join(of("script"), "script", "left")
    limit = F.coalesce("_lang", "_script", fixed)
    beyond = [F.when(~F.col(m).between(limit[f"low_{m}"], limit[f"high_{m}"]), F.lit(m)) for m in MEASURES]
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    scope = F.when(F.col("_lang").isNotNull(), F.concat(F.lit("lang "), "lang")).when(F.col("_script").isNotNull(), F.concat(F.lit("script "), "script"))
    judged = rows.withColumns({"base_failed": base, "band": F.coalesce(scope, F.lit("any")), "outside": F.concat_ws(",", *beyond)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("outside") == "")).drop("_lang", "_script")


def rate_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    tokenizers: str = TOKENIZERS,
    reach: float = REACH,
    min_texts: int = MIN_TEXTS,
) -> DataFrame:
    """Measures and verdict of every text, with bands fitted on all of ``docs``."""
    measured = written(measures(docs, read_vocabularies(tokenizers), id_col, text_col, lang_col), "fertility")
    return judge(measured, written(fit_bands(measured, reach, min_texts), "fertility-bands"))


def drop_poor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose text is kept; rows that share an id are judged apart."""
    rows, row_id = with_rows(docs, id_col, "fertility-rows")
    rated = rate_quality(rows, row_id, text_col, lang_col, **options)
    return keep_rows(rows, rated.where("kept").select("doc_id"), row_id).select(*docs.columns)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, measures and verdict of every document."""
    rated = rate_quality(table(spark, sf_dir, "documents"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rated.select("doc_id", *base, "base_failed", "kept", "lang", "script", "n_tokens", *MEASURES, "band", "outside")
