"""Phrase collocation mining from count streams in prefix and suffix order, operator 12.

N-grams are counted exactly, shortest first; a longer one is counted only where the two n-grams it is made of
may be frequent. The frequent ones are then laid out as streams: sorted by their words from the first to the last
(prefix order), where a phrase follows its own beginnings, and from the last to the first (suffix order), where it
follows its own endings. One pass over a stream, with nothing in hand but the n-grams that the current one begins
with, gives each phrase the counts of its beginnings or endings, and each n-gram its most frequent extension. The
two outputs are merged in lockstep by phrase, again in sorted order; no lookup table is built.

A stream is cut into ranges at sampled keys. The few n-grams that the key at a cut begins with are copied to the
range that starts there, so a first word with any number of phrases is spread over many tasks.

Null texts have no words; a null language is ``und``. Rows that repeat an id count each, as no id is read. Phrases
that tie in score and count are ordered by their UTF-8 bytes. Empty tables, and languages without a candidate, give
no rows. Extra columns are not read. Counts are exact; words are told apart by 64-bit hashes inside one chunk of
text only, and by their bytes everywhere else.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import frugal, table, written
from .tokens import CHUNK_BYTES, LOWER, binary_column, chunks, hash_slices, mix, sequence_hashes, spans

MIN_COUNT = 10
LONGEST = 3
TOP = 2000
SCALE = 1_000_000
#: A phrase goes if a longer candidate with its words has so many hundredths of its count.
COVERED = 50
UNKNOWN = "und"

#: Bytes that end a piece, and bytes between the words of a piece.
ENDS_PIECE = np.zeros(256, dtype=bool)
ENDS_PIECE[np.frombuffer(b".,;:!?\n\x0b\x0c\r", dtype=np.uint8)] = True
IN_WORD = ~ENDS_PIECE
IN_WORD[[0x20, 0x09]] = False

#: N-grams a task holds before it adds them up, and deals or keeps the sums.
HELD_ROWS = 500_000
#: Text whose n-grams a range of the count is for, and ranges at most; a range of a larger corpus holds more n-grams.
COUNT_RANGE_BYTES = 4 << 20
MAX_COUNT_RANGES = 100_000
#: Bits of the filter of frequent n-grams for each of them, and bits in all at most (8 MB in each task). A full
#: filter lets more n-grams through to the exact count; it never loses one.
BITS_EACH = 16
MAX_BITS = 1 << 26
#: N-grams of a range of a stream, ranges at most, and sampled keys for each range.
RANGE_ROWS = 20_000
MAX_RANGES = 10_000
SAMPLED = 20
#: Shares a language's phrases are ranked in before the last ranking, which sees the first of each share.
SHARES = 16


# --- counting


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, the text of each, and the number of its piece."""
    starts, ends, bounds = spans(data, offsets, IN_WORD)
    docs = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    cut = np.cumsum(ENDS_PIECE[data])
    return starts, ends, docs, cut[starts] + docs if len(starts) else starts


def _runs(piece: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """First words of the runs of ``n`` words inside one piece."""
    if len(piece) < n:
        return np.empty(0, np.int64)
    last = slice(n - 1, None)
    first = slice(0, len(piece) - n + 1)
    return np.flatnonzero((piece[first] == piece[last]) & (docs[first] == docs[last]))


def _lang_hashes(langs: list[str]) -> np.ndarray:
    raw = [x.encode() for x in langs]
    ends = np.cumsum([len(x) for x in raw])
    return hash_slices(np.frombuffer(b"".join(raw), np.uint8), ends - [len(x) for x in raw], ends) if raw else np.empty(0, np.uint64)


def _slots(hashes: np.ndarray, langs: np.ndarray, bits: int) -> np.ndarray:
    """Places in a filter of n-grams given by the hashes of their words (one row for each) and language."""
    return mix(hashes ^ langs) & np.uint64(bits - 1)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of one of each distinct key, the number of the distinct key at every place, and how often each is there."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1]) if len(keys) else np.empty(0, bool)
    first = np.flatnonzero(new)
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[first], which, np.diff(np.append(first, len(keys)))


def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Each ``data[start:end]`` as a binary value."""
    upto = np.concatenate([[0], np.cumsum(ends - starts)])
    at = np.arange(upto[-1]) + np.repeat(starts - upto[:-1], ends - starts)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(data[at])])


def _chunk_counts(data: np.ndarray, offsets: np.ndarray, langs: pa.Array, sizes: tuple[int, ...], frequent: np.ndarray | None) -> Iterator[pa.Table]:
    """Every n-gram of the sizes in a chunk once, with its count there and a hash of its words."""
    coded = langs.dictionary_encode()
    names, lang = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    starts, ends, docs, piece = _pieces(data, offsets)
    hashes = hash_slices(data, starts, ends)
    first, ids, _ = _distinct(hashes)
    words = _cut(data, starts[first], ends[first])
    of = lang[docs]
    if 1 in sizes:
        totals = np.bincount(of, minlength=len(names))
        yield _counts(coded.dictionary, np.arange(len(names)), pa.array([b""] * len(names), pa.binary()), totals, np.zeros(len(names), np.uint64))
    for n in sizes:
        runs = _runs(piece, docs, n)
        if frequent is not None and len(runs):
            inner, bits = sequence_hashes(hashes, n - 1), len(frequent) * 8
            known = _lang_hashes(names)[of[runs]]
            seen = np.ones(len(runs), bool)
            for shift in (0, 1):
                slot = _slots(inner[runs + shift], known, bits)
                seen &= (frequent[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
            runs = runs[seen]
        if not len(runs):
            continue
        # N-grams as whole numbers, one word more at a time; renumbered before they outgrow a long.
        key, below = of[runs], len(names)
        for shift in range(n):
            if below * len(first) >= 1 << 62:
                _, key, times = _distinct(key)
                below = len(times)
            key, below = key * np.int64(len(first)) + ids[runs + shift], below * len(first)
        place, _, times = _distinct(key)
        there = runs[place]
        joined = [words.take(pa.array(ids[there + shift])) for shift in range(n)]
        phrases = joined[0] if n == 1 else pc.binary_join_element_wise(*joined, b" ")
        yield _counts(coded.dictionary, of[there], phrases, times, sequence_hashes(hashes, n)[there])


def _counts(names: pa.Array, lang: np.ndarray, phrases: pa.Array, times: np.ndarray, hashes: np.ndarray) -> pa.Table:
    columns = [names.take(pa.array(lang)), phrases, pa.array(times.astype(np.int64)), pa.array(hashes)]
    return pa.Table.from_arrays(columns, ["lang", "phrase", "n", "hash"])


def _summed(tables: list[pa.Table], *also: tuple[str, str]) -> pa.Table:
    """Counts of equal n-grams added up."""
    grouped = pa.concat_tables(tables).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum"), *also])
    return grouped.rename_columns([name.removesuffix("_sum").removesuffix("_min") for name in grouped.schema.names])


def _dealt_counts(sizes: tuple[int, ...], frequent: np.ndarray | None, chunk_bytes: int, ranges: int):
    """Function that counts the n-grams of a task and deals the counts, packed, to ranges of a hash of the n-gram.

    With a filter, an n-gram is left out if one of the two n-grams it is made of is not in the filter.
    """

    def packed(held: list[pa.Table]) -> pa.RecordBatch:
        counts = _summed(held, ("hash", "min"))
        to = (counts["hash"].to_numpy() % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        counts, to = counts.select(["lang", "phrase", "n"]).take(pa.array(order)).combine_chunks(), to[order]
        first = np.flatnonzero(np.diff(to, prepend=-1))
        blocks = [_to_bytes(counts.slice(a, b - a)) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(to)])]
        return pa.RecordBatch.from_arrays([pa.array(to[first].astype(np.int32)), pa.array(blocks, pa.binary())], ["range", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            raw, offsets = binary_column(batch, "text")
            langs = batch.column(batch.schema.get_field_index("lang"))
            for a, b, part, at in chunks(raw, offsets, chunk_bytes):
                held += _chunk_counts(LOWER[part], at, langs.slice(a, b - a), sizes, frequent)
                if sum(map(len, held)) >= HELD_ROWS:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    return run


def _added(min_count: int):
    """Function that adds up the counts of each range, whose rows are sorted together; n-grams below the count go."""

    def often(held: list[pa.Table]) -> pa.RecordBatch:
        counts = _summed(held)
        kept = pc.or_(pc.greater_equal(counts["n"], min_count), pc.equal(counts["phrase"], b""))
        counts = counts.filter(kept).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [counts["lang"].combine_chunks(), counts["phrase"].combine_chunks().cast(pa.string()), counts["n"].combine_chunks()], ["lang", "phrase", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            for number, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if number != current and held:
                    yield often(held)
                    held = []
                current = number
                held.append(pa.ipc.open_stream(block.as_buffer()).read_all())
                if sum(map(len, held[1:])) >= max(HELD_ROWS, len(held[0])):
                    held = [_summed(held)]
        if held:
            yield often(held)

    return run


def _to_bytes(counts: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, counts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(counts)
    return sink.getvalue().to_pybytes()


def _filter(counts: DataFrame, size: int) -> np.ndarray:
    """Bitmap of the n-grams in ``counts``, a power of two of bits that depends on their number up to a limit."""
    bits = min(MAX_BITS, max(1 << 10, 1 << math.ceil(math.log2(1 + BITS_EACH * counts.count()))))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary_column(batch, "phrase")
            starts, ends, bounds = spans(data, offsets, IN_WORD | ENDS_PIECE)
            inner = sequence_hashes(hash_slices(data, starts, ends), size)[bounds[:-1]] if len(starts) else np.empty(0, np.uint64)
            slot = _slots(inner, _lang_hashes(batch.column(1).to_pylist()), bits).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slot >> 6), pa.array(np.int64(1) << (slot & 63))], ["word", "bit"])

    found = counts.select(F.col("phrase").cast("binary").alias("phrase"), "lang").mapInArrow(frugal(slots), "word bigint, bit bigint")
    out = np.zeros(bits // 64, np.int64)
    words = found.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out[words["word"].to_numpy()] = words["bit"].to_numpy()
    return out.view(np.uint8)


def ngram_counts(
    docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """``lang, phrase, n`` of all n-grams of one to ``longest`` words with ``min_count`` occurrences or more.

    The empty phrase has the number of all words of its language, however few.
    """
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang")
    rows = docs.select(lang, docs[text_col].cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, min(MAX_COUNT_RANGES, math.ceil(size / COUNT_RANGE_BYTES)))

    def count(sizes: tuple[int, ...], frequent: np.ndarray | None) -> DataFrame:
        dealt = rows.mapInArrow(frugal(_dealt_counts(sizes, frequent, chunk_bytes, ranges)), "range int, counts binary")
        together = dealt.repartition(ranges, "range").sortWithinPartitions("range")
        return written(together.mapInArrow(frugal(_added(min_count)), "lang string, phrase string, n bigint"), "ngrams")

    out = last = count(tuple(range(1, min(longest, 2) + 1)), None)
    for size in range(3, longest + 1):
        last = count((size,), _filter(last.where(F.size(F.split("phrase", " ")) == size - 1), size - 1))
        out = out.union(last)
    return out


# --- streams


def _sorted(rows: DataFrame, columns: list[str], parents: bool) -> DataFrame:
    """``rows`` as a stream in order of ``lang`` and ``words``, cut into ranges that begin at sampled keys.

    With ``parents``, the rows a cut's key begins with are copied to the range that starts there (``own`` is
    false), so a scan of a range alone knows them. The driver holds one key for each range.
    """
    size = rows.count()
    ranges = max(1, min(MAX_RANGES, math.ceil(size / RANGE_ROWS)))
    some = rows.where(F.pmod(F.xxhash64("lang", "words"), F.lit(max(1, size))) < SAMPLED * ranges).select("lang", "words")
    keys = sorted({(r.lang, *r.words) for r in some.limit(2 * SAMPLED * MAX_RANGES).collect()})
    cuts = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
    begins: dict[tuple, list[int]] = defaultdict(list)
    for number, cut in enumerate(cuts, 1):
        for length in range(2, len(cut)):
            begins[cut[:length]].append(number)
    begins = dict(begins) if parents else {}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, words = batch.column(batch.schema.get_field_index("lang")).to_pylist(), batch.column(batch.schema.get_field_index("words")).to_pylist()
            keys = [(lang, *w) for lang, w in zip(langs, words)]
            at, to, own = list(range(len(keys))), [bisect_right(cuts, key) for key in keys], [True] * len(keys)
            for i, key in enumerate(keys) if begins else ():
                if key in begins:
                    copies = [number for number in begins[key] if number > to[i]]
                    at.extend([i] * len(copies))
                    to.extend(copies)
                    own.extend([False] * len(copies))
            out = batch.select(columns).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(to, pa.int32()), pa.array(own, pa.bool_())], [*columns, "range", "own"])

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", range int, own boolean"
    return rows.select(*columns).mapInArrow(frugal(dealt), schema).repartition(len(cuts) + 1, "range").sortWithinPartitions("range", "lang", "words")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over a sorted stream of n-grams: counts of what each begins with, and each one's best extension.

    In hand are the n-grams the current one begins with: the last one of each length, its count and the most
    frequent n-gram seen that is one word longer. Gives rows of ``parts`` (an n-gram's count and those of its
    beginnings) and rows of ``extension``.
    """
    held: list[list] = []  # [word, count, best extension] of the beginnings of the current n-gram
    where: tuple = ()

    def ended(keep: int, lang: str, out: list) -> None:
        while len(held) > keep:
            if held[-1][2] and len(held) > 1:
                out.append((lang, [h[0] for h in held], None, held[-1][2]))
            held.pop()

    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("range", "lang", "words", "n", "own")]
        for number, lang, words, n, own in zip(*columns):
            if (number, lang) != where:
                ended(0, where[1] if where else lang, out)
                where = (number, lang)
            same = 0
            while same < len(held) and same < len(words) - 1 and held[same][0] == words[same]:
                same += 1
            ended(same, lang, out)
            if held and len(held) == len(words) - 1:
                held[-1][2] = max(held[-1][2], n)
            if own and len(words) > 1:
                out.append((lang, words, [h[1] for h in held] + [n], None))
            held.append([words[-1], n, 0])
        yield _scanned(out)
    out = []
    ended(0, where[1] if where else "", out)
    yield _scanned(out)


_SCANNED = "lang string, words array<string>, parts array<bigint>, extension bigint"


def _scanned(out: list[tuple]) -> pa.RecordBatch:
    kinds = {"lang": pa.string(), "words": pa.list_(pa.string()), "parts": pa.list_(pa.int64()), "extension": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds.values())], list(kinds))


def _merge(covered: int):
    """Function that merges the outputs of both streams, sorted by phrase: adjacent rows are one phrase.

    Numbers are Python integers, as products may pass 64 bits.
    """

    def scored(lang: str, words: tuple, left: list, right: list, extension: int) -> tuple | None:
        a = left[-1]
        if extension * 100 >= covered * a:
            return None
        # Cut after k words: the first k are the k-th beginning, the others the ending of size - k words.
        cuts = [(SCALE * a * a // (left[k - 1] * right[len(words) - k - 1]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        return lang, " ".join(words), a, left[k - 1], right[len(words) - k - 1], score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, left, right, extension = None, None, None, 0
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 4]

        def packed(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], ["lang", "phrase", "a", "l", "r", "score"])

        for batch in batches:
            out = []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("lang", "words", "side", "parts", "extension")]
            for lang, words, side, parts, best in zip(*columns):
                if (lang, *words) != key:
                    if left is not None and (row := scored(key[0], key[1:], left, right, extension)):
                        out.append(row)
                    key, left, right, extension = (lang, *words), None, None, 0
                if parts is None:
                    extension = max(extension, best)
                elif side == "prefix":
                    left = parts
                else:
                    right = parts
            yield packed(out)
        yield packed([row] if left is not None and (row := scored(key[0], key[1:], left, right, extension)) else [])

    return run


def collocations(counts: DataFrame, covered: int = COVERED) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of every phrase in ``counts`` that no longer one covers.

    ``counts`` has all n-grams above the least count, as ``ngram_counts`` gives them: with a phrase it holds its
    beginnings and endings, which are as frequent.
    """
    forward = counts.where("phrase <> ''").select("lang", F.split("phrase", " ").alias("words"), "n")
    backward = forward.withColumn("words", F.reverse("words"))
    sides = []
    for side, stream in (("prefix", forward), ("suffix", backward)):
        scanned = _sorted(stream, ["lang", "words", "n"], parents=True).mapInArrow(frugal(_scan), _SCANNED)
        words = F.col("words") if side == "prefix" else F.reverse("words")
        sides.append(scanned.select("lang", words.alias("words"), F.lit(side).alias("side"), "parts", "extension"))
    both = written(sides[0].union(sides[1]), "ngram-sides")
    merged = _sorted(both, ["lang", "words", "side", "parts", "extension"], parents=False)
    return merged.mapInArrow(frugal(_merge(covered)), "lang string, phrase string, a bigint, l bigint, r bigint, score bigint")


def top_collocations(
    docs: DataFrame, top: int = TOP, longest: int = LONGEST, min_count: int = MIN_COUNT, covered: int = COVERED, text_col: str = "text", lang_col: str = "lang", **options
) -> DataFrame:
    """The first ``top`` phrases of each language by score: ``lang, rank, phrase, a, l, r, n, score``."""
    counts = ngram_counts(docs, longest, min_count, text_col, lang_col, **options)
    order = (F.desc("score"), F.desc("a"), "phrase")
    # A language may have most of the phrases: its first ones are picked share by share, and then among those.
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES)).alias("share")
    picked = collocations(counts, covered).select("*", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
    few = picked.where(F.col("rank") <= top).drop("share", "rank")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = counts.where("phrase = ''").select("lang", "n")
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two or three words of every language of ``documents``."""
    return top_collocations(table(spark, sf_dir, "documents"))


OP12_SQL = """
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents
),
split as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
places as (select lang, w, unnest(range(1, len(w) + 1)) as i from split),
grams as (
  select lang, 1 as size, w[i] as x, '' as y, '' as z, count(*) as f from places group by all
  union all
  select lang, 2, w[i], w[i + 1], '', count(*) from places where i + 1 <= len(w) group by all
  union all
  select lang, 3, w[i], w[i + 1], w[i + 2], count(*) from places where i + 2 <= len(w) group by all
),
totals as (select lang, sum(f) as n from grams where size = 1 group by lang),
often as (select * from grams where f >= 10),
cuts as (
  select b.lang, b.size, b.x, b.y, b.z, b.f as a, l.f as l, r.f as r, 1 as k
  from often b join often l on l.size = 1 and l.lang = b.lang and l.x = b.x
               join often r on r.size = b.size - 1 and r.lang = b.lang and r.x = b.y and r.y = b.z
  where b.size >= 2
  union all
  select b.lang, 3, b.x, b.y, b.z, b.f, l.f, r.f, 2
  from often b join often l on l.size = 2 and l.lang = b.lang and l.x = b.x and l.y = b.y
               join often r on r.size = 1 and r.lang = b.lang and r.x = b.z
  where b.size = 3
),
scored as (
  select *, cast(1000000 * cast(a as hugeint) * a // (cast(l as hugeint) * r) as bigint) as score from cuts
  qualify row_number() over (partition by lang, size, x, y, z order by score, k) = 1
),
covers as (
  select lang, x, y, max(f) as f from (
    select lang, x, y, f from often where size = 3 union all select lang, y, z, f from often where size = 3
  ) group by lang, x, y
),
kept as (
  select s.lang, s.x || ' ' || s.y || case when s.size = 3 then ' ' || s.z else '' end as phrase, s.a, s.l, s.r, s.score
  from scored s left join covers c on s.size = 2 and c.lang = s.lang and c.x = s.x and c.y = s.y
  where c.f is null or 100 * c.f < 50 * s.a
)
select k.lang, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r,
       cast(t.n as bigint) as n, score
from kept k join totals t on t.lang = k.lang
qualify rank <= 2000"""
