"""Near duplicates by min-max hashing of word shingles.

Each permutation gives two values of a set, its minimum and its maximum; both agree for two sets with a
probability equal to their Jaccard similarity, so 126 permutations make 252 signature values. Sets that
share a band of values are candidates, and links are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import bitmap_literal, keep_rows, table, test_bit, texts, with_rows, written
from .links import TASK_FIELDS, TASKS, linked_classes

SHINGLE = 5
#: Links need 100 * intersection >= 85 * union.
PERCENT = 85
PERMUTATIONS = 126
#: Signature values in a band; 42 bands of 6 miss a link at 0.85 with probability (1 - 0.85**6)**42 = 2e-9.
BAND = 6
#: Sets of which fewer of the one-bit signature values agree are no link: at 0.85 a value agrees with
#: probability 0.925, and this is seven standard deviations below for 252 values.
MIN_AGREE = 0.925 - 7 * (0.925 * 0.075 / 252) ** 0.5

_RANDOM = np.random.default_rng(20240229)
_FACTORS = (_RANDOM.integers(0, 1 << 32, 4096, dtype=np.uint32)) | np.uint32(1)
_OFFSETS = _RANDOM.integers(0, 1 << 32, 4096, dtype=np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document of a chunk, sorted, and where each document's begin.

    A document with words but fewer than ``shingle`` has its whole word sequence as its only shingle.
    """
    low = tokens.LOWER[data]
    starts, ends, bounds = tokens.spans(low, offsets, tokens.NOT_SPACE)
    words = tokens.hash_slices(low, starts, ends)
    at = tokens.runs_inside(bounds, shingle)
    hashed = tokens.sequence_hashes(words, shingle)[at] if len(at) else np.empty(0, np.uint64)
    owner = np.searchsorted(bounds, at, side="right") - 1
    size = np.diff(bounds)
    short = np.flatnonzero((size > 0) & (size < shingle))
    whole = [tokens.sequence_hashes(words[bounds[i] : bounds[i + 1]], int(size[i]))[0] ^ np.uint64(size[i]) for i in short]
    hashed = np.concatenate([hashed, np.array(whole, dtype=np.uint64)])
    owner = np.concatenate([owner, short])
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    new = np.ones(len(hashed), dtype=bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    hashed, owner = hashed[new], owner[new]
    return hashed, np.searchsorted(owner, np.arange(len(offsets)))


def signatures(hashed: np.ndarray, bounds: np.ndarray, permutations: int) -> np.ndarray:
    """One row of minima and maxima for each non-empty set; the sets follow each other without gaps."""
    x = (hashed >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, 2 * permutations), dtype=np.uint32)
    for i in range(permutations):
        y = x * _FACTORS[i] + _OFFSETS[i]
        y ^= y >> np.uint32(15)
        out[:, 2 * i] = np.minimum.reduceat(y, bounds[:-1])
        out[:, 2 * i + 1] = np.maximum.reduceat(y, bounds[:-1])
    return out


def set_features(rows: DataFrame, shingle: int, permutations: int, band: int) -> DataFrame:
    """``row, n, d1, d2, sketch, bands`` of every row: set size, digest of the set, one-bit signature, band keys."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = 2 * permutations // band
        salt = tokens.mix(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            data, offsets = tokens.binary_column(batch, "text")
            for first, last, part, own in tokens.chunks(data, offsets):
                hashed, bounds = shingle_sets(part, own, shingle)
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                d1, d2 = np.zeros(last - first, dtype=np.uint64), np.zeros(last - first, dtype=np.uint64)
                keys = np.empty((0, bands), dtype=np.uint64)
                sketches: list[bytes] = [b""] * (last - first)
                if len(full):
                    heads = bounds[:-1][full]
                    d1[full] = np.add.reduceat(tokens.mix(hashed), heads)
                    d2[full] = np.add.reduceat(tokens.mix(hashed ^ np.uint64(0xC2B2AE3D27D4EB4F)), heads)
                    values = signatures(hashed, np.append(heads, len(hashed)), permutations)
                    # One bit of each value, taken after mixing: minima have small top bits, maxima large ones.
                    packed = np.packbits(((values * np.uint32(0x9E3779B1)) >> np.uint32(31)).astype(np.uint8), axis=1)
                    for i, bits in zip(full.tolist(), packed):
                        sketches[i] = bits.tobytes()
                    keys = np.tile(salt, (len(full), 1))
                    for j in range(band):
                        keys = tokens.mix(keys ^ values[:, j : bands * band : band])
                ends = np.zeros(last - first + 1, dtype=np.int32)
                ends[1:] = np.cumsum(n > 0) * bands
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(first, last - first), pa.array(n.astype(np.int64)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))]
                    + [pa.array(sketches, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64)))],
                    ["row", "n", "d1", "d2", "sketch", "bands"],
                )

    return rows.mapInArrow(scan, "row bigint, n bigint, d1 bigint, d2 bigint, sketch binary, bands array<bigint>")


def _send(rows: DataFrame, classes: DataFrame, shingle: int):
    """Puts the sketch and the full shingle set of a text to each of its tasks.

    A bitmap of fixed size keeps most texts that no task wants out of the shuffle.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tokens.binary_column(batch, "text")
            to, sketch = batch.column("to"), batch.column("sketch").to_pylist()
            for first, last, part, own in tokens.chunks(data, offsets):
                hashed, bounds = shingle_sets(part, own, shingle)
                raw = hashed.tobytes()
                sets = [sketch[first + i] + raw[8 * a : 8 * b] for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()))]
                sets = pa.array(sets, pa.binary())
                mine = to.slice(first, last - first)
                owner = np.repeat(np.arange(last - first), np.diff(mine.offsets.to_numpy()))
                # A text wanted by very many tasks is sent on in parts, so a batch stays small.
                flat = mine.flatten()
                step = np.flatnonzero(np.diff(np.cumsum(np.diff(bounds)[owner] * 8) // (16 << 20))) + 1
                for lo, hi in zip([0, *step.tolist()], [*step.tolist(), len(owner)]):
                    at = pa.array(owner[lo:hi])
                    ids = batch.column("row").slice(first, last - first).take(at)
                    yield pa.RecordBatch.from_arrays([*flat.slice(lo, hi - lo).flatten(), ids, sets.take(at)], [*TASKS, "payload"])

    def send(tasks: DataFrame) -> DataFrame:
        wanted = tasks.groupBy("id").agg(F.collect_list(F.struct("k1", "k2", "side", "component")).alias("to"))
        wanted = written(wanted.join(classes.select("id", "sketch"), "id"), "near-wanted").withColumnRenamed("id", "row")
        texts_wanted = rows.where(test_bit(bitmap_literal(wanted.select(F.xxhash64("row").alias("h"))), F.xxhash64("row")))
        return texts_wanted.join(wanted, "row").select("row", "text", "to", "sketch").mapInArrow(extract, TASK_FIELDS)

    return send


def _compare(percent: int, width: int):
    """``read`` and ``partners`` for payloads of a sketch of ``width`` bits and a sorted set."""
    size = (width + 7) // 8
    differ = int((1 - MIN_AGREE) * width) if percent == PERCENT and width >= 252 else width

    def read(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        sketches = np.frombuffer(b"".join(p[:size] for p in payloads), dtype=np.uint8).reshape(-1, size)
        sets = [np.frombuffer(p[size:], dtype=np.uint64) for p in payloads]
        return sketches, np.array([len(s) for s in sets]), sets

    def partners(left, i: int, right, places: list[int]) -> Iterator[int]:
        at = np.array(places)
        n, mine = left[1][i], left[2][i]
        at = at[100 * np.minimum(n, right[1][at]) >= percent * np.maximum(n, right[1][at])]
        at = at[np.bitwise_count(right[0][at] ^ left[0][i]).sum(axis=1) <= differ]
        for j in at.tolist():
            # Both are sorted and free of repeats: sorted together, shared values stand next to each other.
            both = np.concatenate([mine, right[2][j]])
            both.sort(kind="stable")
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            if 100 * common >= percent * (len(both) - common):
                yield j

    return read, partners


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    permutations: int = PERMUTATIONS,
    band: int = BAND,
    row_col: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept, row``.

    Words lie between white space, A-Z in lower case. Texts whose shingle sets have a similarity of
    ``percent`` or more are linked; ``component_id`` is the smallest id reachable over links and ``kept`` marks
    its row. A text without words (missing and empty ones too) is linked with nothing. Rows that repeat an id
    are rows of their own, of which one is kept if they carry the component's id; a missing id counts as
    larger than any other.
    """
    if row_col is None:
        docs, row_col = with_rows(docs, id_col, "near-rows")
    rows = texts(docs, id_col, text_col, docs[row_col].cast("bigint").alias("row"))
    ids = rows.select("row", "doc_id")
    rows = rows.select("row", "text")
    found = written(set_features(rows, shingle, permutations, band), "near-features")
    # Equal sets are one class from the start, however many; its smallest row stands for it.
    classes = (
        found.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("row").alias("id"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands"))
    )
    classes = written(classes, "near-classes")
    members = classes.select("id", F.explode("bands").alias("bucket")).select("bucket", "id")
    components = linked_classes(members, _send(rows, classes, shingle), *_compare(percent, 2 * permutations), "near")
    digest = ["d1", "d2", "n"]
    head = classes.join(components, "id", "left").select(*digest, F.coalesce("component", "id").alias("component"))
    head = written(head, "near-heads")
    marked = found.select("row", *digest).join(head, digest, "left").select("row", "n", F.coalesce("component", "row").alias("component"))
    marked = written(marked.join(ids, "row"), "near-marked")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    # Written, so that the join below is free to split a component of very many rows.
    firsts = written(marked.groupBy("component").agg(first), "near-firsts")
    return marked.join(firsts, "component").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("first.doc_id").alias("component_id"),
        (F.col("first.row") == F.col("row")).alias("kept"),
        "row",
    )


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all its columns, one row of each group of near duplicates."""
    rows, number = with_rows(docs, id_col, "near-rows")
    kept = near_groups(rows, id_col, text_col, row_col=number, **options).where("kept").select("row")
    return keep_rows(rows, kept, number).select(*docs.columns)


def op6_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).drop("row")
