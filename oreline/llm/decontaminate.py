"""Benchmark items in documents, also with other numbers, names and units, by template windows.

Words become a template: numbers, names and units turn into typed placeholders. Windows of a document's
template are joined by hash with those of the benchmark; along one alignment each value of the item must
then stand for one value of the document, and windows in which it stands for another one do not count. A
bitmap of fixed size made of the benchmark's windows keeps most document windows from the join; a larger
benchmark only lets more of them through.

An item too short, or with too few words besides placeholders, for a window is looked for word for word, from
``MIN_WORDS`` words on; shorter ones are in no document. Rows of documents are judged one by one, also those
that share an id or have none; so are items. Missing and empty texts hold nothing and are held by nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import table, texts, with_rows, written

WINDOW = 5
#: Share of an item's windows that must be found.
MIN_SHARE = 0.8
#: Words of a window that must not be placeholders.
MIN_CONTENT = 3
#: Words of the shortest item that is looked for word for word.
MIN_WORDS = 3
GATE_BITS = 1 << 23

#: Number words of four languages; those that are articles as well are left out.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half dozen "
    "null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn "
    "zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend millionen milliarde dutzend "
    "zéro deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante cinquante "
    "soixante cent mille millions milliard douzaine "
    "cero dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince veinte treinta cuarenta cincuenta sesenta "
    "setenta ochenta noventa cien ciento mil millón millones docena"
).split()
UNIT_WORDS = (
    "m km cm mm mile miles metre metres meter meters kilometre kilometres kilometer kilometers foot feet inch inches yard yards "
    "g kg mg gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes l ml litre litres liter liters gallon "
    "gallons second seconds minute minutes hour hours day days week weeks month months year years dollar dollars euro euros cent "
    "cents pence usd eur gbp percent degree degrees celsius fahrenheit kelvin watt watts volt volts joule joules newton newtons"
).split()

_NUMBER, _UNIT, _NAME = (int(x) for x in (0xA5A5A5A5A5A5A501, 0xA5A5A5A5A5A5A502, 0xA5A5A5A5A5A5A503))


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    starts, ends, _ = tokens.spans(data, np.array([0, len(data)]), tokens.ALNUM)
    return np.sort(tokens.hash_slices(data, starts, ends))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def template(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template hash, value hash and placeholder flag of every word of a chunk, and where documents begin.

    A word lies between white space, without the punctuation around it. It is a number if it begins with a
    digit or is a number word, a unit if listed, a name if it begins with a capital.
    """
    spaced, _, _ = tokens.spans(data, offsets, tokens.NOT_SPACE)
    starts, ends, _ = tokens.spans(data, offsets, tokens.ALNUM)
    if not len(starts):
        empty = np.empty(0, np.uint64)
        return empty, empty, np.empty(0, bool), np.zeros(len(offsets), np.int64)
    word = np.searchsorted(spaced, starts, side="right")
    first = np.ones(len(starts), dtype=bool)
    first[1:] = word[1:] != word[:-1]
    last = np.append(first[1:], True)
    starts, ends = starts[first], ends[last]
    low = tokens.LOWER[data]
    value = tokens.hash_slices(low, starts, ends)
    head = data[starts]
    second = data[np.minimum(starts + 1, len(data) - 1)]
    capital = ((head >= 65) & (head <= 90)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    number = ((head >= 48) & (head <= 57)) | _among(value, _hashes(NUMBER_WORDS))
    unit = ~number & _among(value, _hashes(UNIT_WORDS))
    name = capital & ~number & ~unit
    form = value.copy()
    for mask, mark in ((number, _NUMBER), (unit, _UNIT), (name, _NAME)):
        form[mask] = mark
    return form, value ^ form, number | unit | name, np.searchsorted(starts, offsets)


def template_windows(rows: DataFrame, id_name: str, window: int, min_content: int, gate: np.ndarray | None, verbatim: bool = False) -> DataFrame:
    """``<id>, pos, hash, slots`` of the windows of ``rows`` (id and binary text) that pass the gate.

    ``slots`` holds the values of the placeholders of a window in order; ``verbatim`` windows have none.
    """
    schema = f"{id_name} bigint, pos bigint, hash bigint, slots array<bigint>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tokens.binary_column(batch, "text")
            ids = batch.column(0)
            for first, last, part, own in tokens.chunks(data, offsets):
                form, value, placed, bounds = template(part, own)
                if verbatim:
                    form, placed = form ^ value, np.zeros(len(form), bool)
                at = tokens.runs_inside(bounds, window)
                if not len(at):
                    continue
                content = np.concatenate([[0], np.cumsum(~placed)])
                hashed = tokens.sequence_hashes(form, window)
                at = at[content[at + window] - content[at] >= min_content]
                if gate is not None:
                    slot = (hashed[at] & np.uint64(len(gate) * 64 - 1)).astype(np.int64)
                    at = at[(gate[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1]
                owner = np.searchsorted(bounds, at, side="right") - 1
                inside = at[:, None] + np.arange(window)[None, :]
                mask = placed[inside]
                ends = np.concatenate([[0], np.cumsum(mask.sum(axis=1))]).astype(np.int32)
                slots = pa.ListArray.from_arrays(pa.array(ends), pa.array(value[inside][mask].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(first + owner)), pa.array(at - bounds[owner]), pa.array(hashed[at].view(np.int64)), slots],
                    [id_name, "pos", "hash", "slots"],
                )

    return rows.mapInArrow(cut, schema)


def _gate(windows: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the windows' hashes; at most ``bits`` / 64 numbers come to the driver."""
    slot = F.pmod(F.col("hash"), F.lit(bits))
    rows = (
        windows.select((slot / 64).cast("int").alias("word"), F.expr("shiftleft(1L, cast(pmod(hash, 64) as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    for row in rows:
        out[row.word] = row.bits
    return out.view(np.uint64)


def _aligned(hits: DataFrame) -> DataFrame:
    """``row, item, windows, exact`` of each alignment of an item with a document: the windows that agree.

    Most windows decide what value of the document a value of the item stands for (ties: the largest hash); windows
    with another value there do not count. An item bounds the number of its windows, and so what is gathered.
    """
    pairs = F.zip_with("item_slots", "slots", lambda item, value: F.struct(item.alias("item"), value.alias("value")))
    grouped = hits.groupBy("row", "item", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.collect_set(F.struct(F.col("item_pos").alias("at"), pairs.alias("pairs"))).alias("windows")
    )
    every = grouped.withColumn("pairs", F.flatten(F.col("windows.pairs")))
    counted = F.transform(
        F.array_distinct("pairs"),
        lambda p: F.struct(p["item"].alias("item"), F.size(F.filter("pairs", lambda x: x == p)).alias("n"), p["value"].alias("value")),
    )
    chosen = F.filter("counted", lambda c: ~F.exists("counted", lambda x: (x["item"] == c["item"]) & (F.struct(x["n"], x["value"]) > F.struct(c["n"], c["value"]))))
    stands = F.map_from_entries(F.transform("chosen", lambda c: F.struct(c["item"], c["value"])))
    agree = F.filter("windows", lambda w: F.forall(w["pairs"], lambda p: F.element_at("stands", p["item"]) == p["value"]))
    kept = every.withColumn("counted", counted).withColumn("chosen", chosen).withColumn("stands", stands).withColumn("agreeing", agree)
    exact = F.forall("agreeing", lambda w: F.forall(w["pairs"], lambda p: p["item"] == p["value"]))
    return kept.where(F.size("agreeing") > 0).select("row", "item", F.col("agreeing.at").alias("windows"), exact.alias("exact"))


def _hits(rows: DataFrame, items: DataFrame, window: int, min_content: int, gate_bits: int, verbatim: bool) -> DataFrame:
    """Windows of ``rows`` that are windows of ``items`` as well."""
    held = items.toDF("item", "item_pos", "hash", "item_slots")
    found = template_windows(rows, "row", window, min_content, _gate(held, gate_bits), verbatim)
    return found.join(held, "hash").where(F.size("slots") == F.size("item_slots")).select("row", "item", "pos", "item_pos", "item_slots", "slots")


def _row_items(rows: DataFrame, items: DataFrame, window: int, min_share: float, min_content: int, gate_bits: int) -> DataFrame:
    """``row, item, share, exact`` for ``rows`` and ``items`` of a number and a binary text each."""
    cut = written(template_windows(items, "item", window, min_content, None), "decontaminate-items")
    found, totals = [_aligned(_hits(rows, cut, window, min_content, gate_bits, False))], [cut]
    # Items without a window are looked for word for word: whole if shorter than a window, else by their windows.
    rest = items.join(cut.select("item"), "item", "left_anti")
    for n in range(MIN_WORDS, window + 1):
        whole = template_windows(rest, "item", n, 0, None, True)
        if n < window:
            longer = template_windows(rest, "item", n + 1, 0, None, True).select("item")
            whole = whole.join(longer, "item", "left_anti")
        whole = written(whole, "decontaminate-short")
        if not whole.isEmpty():
            found.append(_aligned(_hits(rows, whole, n, 0, gate_bits, True)))
            totals.append(whole)
    hits, windows = found[0], totals[0].select("item", "pos")
    for more, own in zip(found[1:], totals[1:]):
        hits, windows = hits.unionByName(more), windows.unionByName(own.select("item", "pos"))
    counts = windows.groupBy("item").agg(F.count_distinct("pos").alias("n_windows"))
    return (
        hits.groupBy("row", "item")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("windows")))).alias("n"), F.min("exact").alias("exact"))
        .join(counts, "item")
        .where(F.col("n") >= F.lit(min_share) * F.col("n_windows"))
        .select("row", "item", F.least(F.lit(1.0), F.col("n") / F.col("n_windows")).alias("share"), "exact")
    )


@dataclass(frozen=True)
class _Found:
    """Documents with a column that tells rows apart, and the items found by it."""

    docs: DataFrame
    row: str
    items: DataFrame


def _found(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str,
    text_col: str,
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    min_share: float = MIN_SHARE,
    min_content: int = MIN_CONTENT,
    gate_bits: int = GATE_BITS,
) -> _Found:
    docs, row = with_rows(docs, id_col, "decontaminate-rows")
    benchmark, item = with_rows(benchmark, item_col, "decontaminate-benchmark")
    found = _row_items(texts(docs, row, text_col).toDF("row", "text"), texts(benchmark, item, item_text_col).toDF("item", "text"), window, min_share, min_content, gate_bits)
    names = benchmark.select(benchmark[item].cast("bigint").alias("item"), benchmark[item_col].cast("bigint").alias("item_id"))
    return _Found(docs, row, written(found.join(names, "item").select("row", "item_id", "share", "exact"), "decontaminate-found"))


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, item_id, share, exact``: items of which at least ``min_share`` of the windows are in a document.

    Only windows with ``min_content`` words that are no placeholders count, if an item has one; ``exact`` tells
    that all values are the item's own. One row for each row of ``docs`` and of ``benchmark`` that match.
    """
    found = _found(docs, benchmark, id_col, text_col, **options)
    ids = found.docs.select(found.docs[found.row].cast("bigint").alias("row"), found.docs[id_col].cast("bigint").alias("doc_id"))
    return found.items.join(ids, "row").select("doc_id", "item_id", "share", "exact")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, contaminated, n_items, item_id, share`` (of the item found most fully)."""
    found = _found(docs, benchmark, id_col, text_col, **options)
    best: Column = F.max(F.struct("share", (-F.col("item_id")).alias("order")))
    per_row = found.items.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), best.alias("best"))
    ids = found.docs.select(found.docs[found.row].cast("bigint").alias("row"), found.docs[id_col].cast("bigint").alias("doc_id"))
    return ids.join(per_row, "row", "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        (-F.col("best.order")).alias("item_id"),
        F.col("best.share").alias("share"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all its columns without the rows that hold a benchmark item."""
    found = _found(docs, benchmark, id_col, text_col, **options)
    bad = found.items.select("row").distinct().toDF("__bad_row")
    return found.docs.join(bad, found.docs[found.row].cast("bigint") == bad["__bad_row"], "left_anti").select(*docs.columns)


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
