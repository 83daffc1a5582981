"""Passages that occur more than once, by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the smallest hash among the runs of
``minimiser`` words in it, the leftmost of equal ones. Consecutive windows with the same minimiser
position travel as one packed string to the bucket of that minimiser; equal windows meet there, and
sorting counts them. A minimiser seen once cannot belong to a repeated window, so only those seen again
are cut out of the texts; equal packed strings are counted before they are dealt to buckets. Windows of a
minimiser with very many strings are dealt one by one instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import bitmap_literal, frugal, table, test_bit, texts, with_rows, written

WINDOW = 35
MINIMISER = 12
#: Bytes of packed strings counted at once in a bucket task; only whole minimisers are counted.
BLOCK_BYTES = 4 << 20
#: Bytes of packed strings hashed at once; hashing takes some fifty times as much memory.
PART_BYTES = 1 << 20
#: A minimiser with more bytes of packed strings is counted window by window, in no single task.
HOT_BYTES = 4 << 20


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of every ``width`` consecutive values, the leftmost of equal ones."""
    best, at, size = values, np.arange(len(values)), 1
    while size < width:
        shift = min(size, width - size)
        later = best[shift:] < best[:-shift]
        at = np.where(later, at[shift:], at[:-shift])
        best = np.where(later, best[shift:], best[:-shift])
        size += shift
    return at


def super_kmers(words: np.ndarray, bounds: np.ndarray, window: int, minimiser: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser hash of every super-k-mer of a chunk."""
    starts = tokens.runs_inside(bounds, window)
    if not len(starts):
        return starts, starts, np.empty(0, np.uint64)
    short = tokens.sequence_hashes(words, minimiser)
    at = leftmost_minima(short, window - minimiser + 1)[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    return starts[first], np.diff(np.append(first, len(starts))), short[at[first]]


def _find(rows: DataFrame, window: int, minimiser: int) -> DataFrame:
    """``row, start, n, bucket`` of every super-k-mer."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tokens.binary_column(batch, "text")
            ids = batch.column("row").to_numpy()
            for first, _, part, own in tokens.chunks(data, offsets):
                starts, ends, bounds = tokens.spans(part, own, tokens.NOT_SPACE)
                at, n, bucket = super_kmers(tokens.hash_slices(part, starts, ends), bounds, window, minimiser)
                owner = np.searchsorted(bounds, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first + owner]), pa.array((at - bounds[owner]).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(bucket.view(np.int64))],
                    ["row", "start", "n", "bucket"],
                )

    return rows.mapInArrow(frugal(scan), "row bigint, start int, n int, bucket bigint")


def _cut(rows: DataFrame, window: int) -> DataFrame:
    """``row, start, bucket, packed``: words of the super-k-mers in ``rows`` (``row, text, pieces``), one space between."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tokens.binary_column(batch, "text")
            pieces = batch.column("pieces")
            piece_ends = pieces.offsets.to_numpy()
            flat = pieces.flatten()
            begin, count, bucket = (flat.field(i).to_numpy() for i in range(3))
            piece_ends = piece_ends - piece_ends[0]
            for first, last, part, own in tokens.chunks(data, offsets):
                starts, ends, bounds = tokens.spans(part, own, tokens.NOT_SPACE)
                mine = slice(piece_ends[first], piece_ends[last])
                owner = np.repeat(np.arange(first, last), np.diff(piece_ends[first : last + 1]))
                head = bounds[owner - first] + begin[mine]
                # Texts with one space between words are cut as they are; else words are joined anew.
                gap = np.append(starts[1:], len(part)) - ends
                odd = np.concatenate([[0], np.cumsum((gap != 1) | (part[np.minimum(ends, len(part) - 1)] != 32))])
                tail = head + count[mine] + window - 2
                plain = odd[tail] == odd[head]
                raw = part.tobytes()
                packed = [
                    raw[starts[a] : ends[b]] if ok else b" ".join([raw[s:e] for s, e in zip(starts[a : b + 1], ends[a : b + 1])])
                    for a, b, ok in zip(head.tolist(), tail.tolist(), plain.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(owner)), pa.array(begin[mine]), pa.array(bucket[mine]), pa.array(packed, pa.binary())],
                    ["row", "start", "bucket", "packed"],
                )

    return rows.mapInArrow(frugal(cut), "row bigint, start int, bucket bigint, packed binary")


def _second_hash(words: np.ndarray, n: int) -> np.ndarray:
    return tokens.sequence_hashes(words ^ np.uint64(0x5851F42D4C957F2D), n)


def _windows(batch: pa.RecordBatch, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """String, place within it and two hashes of every window of the column ``packed``, a part of the strings at a time."""
    data, offsets = tokens.binary_column(batch, "packed")
    for first, _, part, own in tokens.chunks(data, offsets, PART_BYTES):
        starts, ends, bounds = tokens.spans(part, own, tokens.NOT_SPACE)
        words = tokens.hash_slices(part, starts, ends)
        at = tokens.runs_inside(bounds, window)
        owner = np.searchsorted(bounds, at, side="right") - 1
        yield first + owner, at - bounds[owner], tokens.sequence_hashes(words, window)[at], _second_hash(words, window)[at]


def _count(strings: DataFrame, window: int) -> DataFrame:
    """``k1, k2, mask`` of packed strings: bit i is set if the i-th window occurs more than once.

    ``strings`` (``bucket, packed, n``) are distinct, dealt and sorted by bucket.
    """

    def judge(packed: pa.Array, times: np.ndarray) -> np.ndarray:
        owner, place, one, two = (np.concatenate(x) for x in zip(*_windows(pa.RecordBatch.from_arrays([packed], ["packed"]), window)))
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        group = np.cumsum(new) - 1
        again = np.bincount(group, weights=times[owner[order]])[group] >= 2
        mask = np.zeros(len(times), dtype=np.int64)
        hit = order[again]
        np.bitwise_or.at(mask, owner[hit], np.int64(1) << place[hit])
        return mask

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0

        def flush(block: pa.Table) -> pa.RecordBatch:
            block = block.combine_chunks()
            packed = block["packed"].combine_chunks().cast(pa.large_binary())
            mask = judge(packed, block["n"].to_numpy().astype(np.float64))
            keep = pa.array(mask != 0)
            return pa.Table.from_arrays([block["k1"], block["k2"], pa.array(mask)], ["k1", "k2", "mask"]).filter(keep)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size < BLOCK_BYTES:
                continue
            block = pa.concat_tables(held)
            buckets = block["bucket"].to_numpy()
            cut = int(np.searchsorted(buckets, buckets[-1]))
            if cut:
                yield from flush(block.slice(0, cut)).to_batches()
                block = block.slice(cut)
            held, size = [block], block.nbytes
        if held:
            yield from flush(pa.concat_tables(held)).to_batches()

    return strings.mapInArrow(frugal(count), "k1 bigint, k2 bigint, mask bigint")


def _count_spread(strings: DataFrame, window: int) -> DataFrame:
    """Like ``_count`` for strings in any order: windows are dealt by their hashes, equal ones added up before they are."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, place, one, two in _windows(batch, window):
                columns = [batch.column(c).take(pa.array(owner)) for c in ("k1", "k2", "n")]
                columns += [pa.array(place.astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "n", "place", "one", "two"])

    fields = "k1 bigint, k2 bigint, n bigint, place int, one bigint, two bigint"
    # Written, so that the join below is free to split a window that very many strings hold.
    windows = written(strings.select("k1", "k2", "n", "packed").mapInArrow(frugal(explode), fields), "repeats-windows")
    again = written(windows.groupBy("one", "two").agg(F.sum("n").alias("times")).where("times > 1").select("one", "two"), "repeats-windows-again")
    bit = F.expr("shiftleft(1L, place)")
    return windows.join(again, ["one", "two"]).groupBy("k1", "k2").agg(F.bit_or(bit).alias("mask"))


def _known(rows: DataFrame, some: DataFrame, known: bool = True) -> DataFrame:
    """Those of ``rows`` that a bitmap of fixed size takes for rows of ``some``, or the others: no text is shuffled for it."""
    bit = test_bit(bitmap_literal(some.select(F.xxhash64("row").alias("h"))), F.xxhash64("row"))
    return rows.where(bit if known else ~bit)


def repeated_windows(rows: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """``row, found`` for the rows (``row, text``) that hold a window which also occurs elsewhere.

    ``found`` lists ``start, mask``: bit i of the mask stands for the window at word ``start + i``.
    """
    if not 0 < minimiser <= window or window - minimiser + 1 > 63:
        raise ValueError("minimiser must be at most the window and less than 63 words shorter")
    pieces = written(_find(rows, window, minimiser), "repeats-pieces")
    # Written, so that the join below is free to split a minimiser that occurs very often.
    again = written(pieces.groupBy("bucket").count().where("count > 1").select("bucket"), "repeats-again")
    per_row = pieces.join(again, "bucket").groupBy("row").agg(F.collect_list(F.struct("start", "n", "bucket")).alias("pieces"))
    per_row = written(per_row, "repeats-rows")
    packed = _cut(_known(rows, per_row).join(per_row, "row"), window)
    keys = [F.xxhash64("packed").alias("k1"), F.xxhash64(F.lit(1), "packed").alias("k2")]
    packed = written(packed.select("row", "start", "bucket", "packed", *keys), "repeats-packed")
    hot = written(packed.groupBy("bucket").agg(F.sum(F.octet_length("packed")).alias("bytes")).where(F.col("bytes") > HOT_BYTES).select("bucket"), "repeats-hot")

    def distinct(strings: DataFrame) -> DataFrame:
        return strings.groupBy("bucket", "packed", "k1", "k2").agg(F.count(F.lit(1)).alias("n"))

    if hot.isEmpty():
        masks = _count(distinct(packed).repartition("bucket").sortWithinPartitions("bucket"), window)
    else:
        cold = distinct(packed.join(hot, "bucket", "left_anti"))
        masks = _count(cold.repartition("bucket").sortWithinPartitions("bucket"), window)
        masks = masks.union(_count_spread(distinct(packed.join(hot, "bucket", "left_semi")), window))
    found = packed.select("row", "start", "k1", "k2").join(masks, ["k1", "k2"])
    return found.groupBy("row").agg(F.collect_list(F.struct("start", "mask")).alias("found"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, minimiser: int = MINIMISER, keep_text: bool = True
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256`` and, with ``keep_text``, ``kept_text``.

    Words are separated by white space. A word goes if a window of ``window`` words covers it whose words also
    start anywhere else, in the same text too; windows are judged on the input. ``kept_text`` has the other
    words with one space between. A text shorter than a window (missing and empty ones too) keeps all its
    words; repeated rows are texts of their own and so remove each other.
    """
    docs, key = with_rows(docs, id_col, "repeats-rows")
    rows = texts(docs, id_col, text_col, docs[key].cast("bigint").alias("row"))
    found = repeated_windows(rows.select("row", "text"), window, minimiser)
    fields = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept_text string" if keep_text else "")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tokens.binary_column(batch, "text")
            found = batch.column("found")
            n_words, n_removed, digests, kept_texts = [], [], [], []
            for first, last, part, own in tokens.chunks(data, offsets):
                starts, ends, bounds = tokens.spans(part, own, tokens.NOT_SPACE)
                keep = np.ones(len(starts), dtype=bool)
                for i in range(first, last):
                    if found[i].is_valid:
                        flat = found[i].values
                        start, mask = flat.field(0).to_numpy(), flat.field(1).to_numpy()
                        bits = (mask[:, None] >> np.arange(window - minimiser + 1)) & 1
                        piece, shift = np.nonzero(bits)
                        at = start[piece] + shift
                        size = bounds[i - first + 1] - bounds[i - first]
                        cover = np.zeros(size + 1, dtype=np.int64)
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + window, -1)
                        keep[bounds[i - first] : bounds[i - first + 1]] = np.cumsum(cover)[:-1] == 0
                raw = part.tobytes()
                for i in range(first, last):
                    a, b = bounds[i - first], bounds[i - first + 1]
                    chosen = np.flatnonzero(keep[a:b])
                    words = raw[own[i - first] : own[i - first + 1]].split()
                    kept = b" ".join(words if len(chosen) == b - a else [words[j] for j in chosen.tolist()])
                    n_words.append(b - a)
                    n_removed.append(b - a - len(chosen))
                    digests.append(hashlib.sha256(kept).hexdigest())
                    if keep_text:
                        kept_texts.append(kept.decode())
            columns = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            columns += [pa.array(kept_texts, pa.string())] if keep_text else []
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in fields.split(", ")])

    found = written(found, "repeats-found")
    # Texts without a find keep all their words where they are.
    hit = _known(rows, found).join(found, "row", "left")
    kind = found.schema["found"].dataType
    rest = _known(rows, found, False).withColumn("found", F.lit(None).cast(kind))
    return hit.select("doc_id", "text", "found").unionByName(rest.select("doc_id", "text", "found")).mapInArrow(frugal(strip), fields)


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)
