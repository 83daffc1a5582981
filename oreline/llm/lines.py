"""Repeated and nearly repeated lines by a segment-partition edit join.

Two strings within edit distance t, of which one is cut into t + 1 segments, share one of these segments
whole. So every line is indexed under its segments and probes, at the places a partner's segment may have, the
few substrings that could be one. Lines that meet under a segment, and whose lengths and counts of characters
fit, are candidates; a banded bit-parallel edit distance verifies them. The limit t grows with the length of a line unless the caller fixes it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed, tokens
from .common import bitmap_literal, frugal, table, test_bit, texts, with_rows, written
from .links import PAIRS, TASKS, Pairwise, _tiles, linked_classes

#: Edit distance (in characters) up to which lines are the same.
THRESHOLD = 2
#: Without a fixed threshold, longer lines may differ by one edit in so many characters, up to MAX_EDITS.
CHARS_PER_EDIT = 12
MAX_EDITS = 9
#: Such lines also agree in this share of the longer one's characters.
MIN_SIMILARITY = 0.8
#: Lengths of a band grow by this factor; a segment is known by a run of so many of its characters at least.
BAND_GROWTH = 1.2
MIN_RUN = 12
WORD = 64
#: Classes of characters counted before two lines are compared.
LETTERS = 32
#: Classes of characters, of four bits each, in the sketch that travels with a line's keys.
SKETCH = 8
#: Keys and hashes of lines travel with so many bits beyond those that number them. Lines that agree in both are told
#: apart later, by their texts.
KEY_SPARE, SHORT_SPARE = 6, 4
#: Lines under a key that are paired by their sketches; more stay together unpaired.
PAIRED = 1024
#: Bytes of lines whose keys are made at once.
CHUNK_BYTES = 4 << 20
#: Bits of the filter of lines that meet others: 512 KB.
KNOWN_BITS = 1 << 22
#: Pairs whose columns are taken in step.
STEP_PAIRS = 4096

#: White space around a line; a line feed ends it.
BLANK = b" \t\x0b\x0c\r"


def edit_limit(size: int, threshold: int | None, min_similarity: float) -> int:
    """Edits up to which a line is the same as one of ``size`` characters that is no shorter."""
    most = min(MAX_EDITS, max(THRESHOLD, size // CHARS_PER_EDIT)) if threshold is None else threshold
    return min(most, int((1 - min_similarity) * size + 1e-9))


def length_bands(longest: int, threshold: int | None, min_similarity: float) -> list[tuple[int, int, int]]:
    """``low, high, t``: lengths from ``low`` to below ``high``, in which the limit is ``t`` throughout."""
    bands, low = [], 1
    while low <= longest:
        t = edit_limit(low, threshold, min_similarity)
        high = max(low + 1, int(low * BAND_GROWTH))
        while high > low + 1 and edit_limit(high - 1, threshold, min_similarity) != t:
            high -= 1
        if t:
            bands.append((low, high, t))
        low = high
    return bands


def segment_keys(code: np.ndarray, size: np.ndarray, threshold: int | None, min_similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all lines, the line each belongs to, and whether it is one of the line's own segments.

    The lines' characters ``code`` lie end to end, shorter lines first; ``size`` has their lengths. A key stands
    for (length band, segment number, smallest hash among the segment's runs of characters). The lines of a band,
    and shorter ones within reach of it, are indexed under segments at the same places. The lines of the band
    probe at those places at which the text left and right of the segment can be within reach; neighbouring
    places mostly have the same smallest hash, so a probe costs few keys.
    """
    keys, owners, own = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, bool)]
    power, inverse = tokens.powers(len(code) + 1)
    sums = np.zeros(len(code) + 1, dtype=np.uint64)
    letters = tokens.mix(np.arange(1, int(code.max(initial=0)) + 2, dtype=np.uint64))
    np.cumsum(letters[code] * power[: len(code)], out=sums[1:])
    bounds = np.concatenate([[0], np.cumsum(size)])
    for low, high, t in length_bands(int(size.max(initial=0)), threshold, min_similarity):
        first, last = np.searchsorted(size, [low - t, high])
        if first == last:
            continue
        begin, n, probing = bounds[first:last, None] - bounds[first], size[first:last, None], size[first:last, None] >= low
        seg = max(0, low - t) // (t + 1)
        run = min(seg, max(MIN_RUN, seg // 2))
        at = slice(bounds[first], bounds[last] - run + 1)
        least_hash = (sums[bounds[first] + run : bounds[last] + 1] - sums[at]) * inverse[at]
        width = 1
        while width < seg - run + 1:
            step = min(width, seg - run + 1 - width)
            least_hash = np.minimum(least_hash[:-step], least_hash[step:])
            width += step
        for i in range(t + 1 if seg else 1):
            least, most = (-min(i, t - i), i) if seg else (0, 0)
            place = i * seg + np.arange(least, most + 1)
            ok = (place >= 0) & (place + seg <= n)
            hashed = least_hash[np.where(ok, begin + place, 0)]
            ok &= probing & (hashed != hashed[:, -least, None])
            ok[:, 1:] &= (hashed[:, 1:] != hashed[:, :-1]) | ~ok[:, :-1]
            ok[:, -least] = True
            row, column = np.nonzero(ok)
            keys.append(tokens.mix(hashed[row, column] ^ tokens.mix(np.full(1, (low << 8) + i + 1, np.uint64))))
            owners.append(first + row)
            own.append(column == -least)
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(own)


def line_table(rows: DataFrame) -> DataFrame:
    """``row, line_no, line, line_text`` of every line that is not blank.

    ``line`` is a 64-bit hash of the trimmed line, ``line_text`` its bytes where a chunk of rows has it first, else null.
    """
    fields = ["row", "line_no", "line", "line_text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("row").to_numpy()
            data, offsets = tokens.binary_column(batch, "text")
            for first, last, part, own in tokens.chunks(data, offsets):
                raw, hashes = part.tobytes(), {}
                owner, number, digests, texts_ = [], [], [], []
                for i in range(first, last):
                    for k, line in enumerate(raw[own[i - first] : own[i - first + 1]].split(b"\n")):
                        line = line.strip(BLANK)
                        if not line:
                            continue
                        new = line not in hashes
                        if new:
                            hashes[line] = hashlib.blake2b(line, digest_size=8).digest()
                        owner.append(i)
                        number.append(k)
                        digests.append(hashes[line])
                        texts_.append(line if new else None)
                columns = [pa.array(ids[np.array(owner, np.int64)]), pa.array(number, pa.int32()), pa.array(np.frombuffer(b"".join(digests), np.int64)), pa.array(texts_, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, fields)

    return rows.mapInArrow(frugal(scan), "row bigint, line_no int, line bigint, line_text binary")


def _limits(size: np.ndarray, threshold: int | None, min_similarity: float) -> np.ndarray:
    """``edit_limit`` of many sizes."""
    most = np.clip(size // CHARS_PER_EDIT, THRESHOLD, MAX_EDITS) if threshold is None else np.full(size.shape, threshold)
    return np.minimum(most, ((1 - min_similarity) * size + 1e-9).astype(np.int64))


def _sketches(code: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Four bits for each of ``SKETCH`` classes of characters: how many a line has of it, modulo 16."""
    kind = ((code * np.uint32(2654435761)) >> np.uint32(29)).astype(np.int64)
    counts = np.bincount(np.repeat(np.arange(len(size)) * SKETCH, size) + kind, minlength=len(size) * SKETCH).reshape(-1, SKETCH) & 15
    return (counts << (4 * np.arange(SKETCH))).sum(axis=1).astype(np.uint32)


def _buckets(keys: np.ndarray, ids: np.ndarray, own: np.ndarray, size: np.ndarray, sketch: np.ndarray, threshold: int | None, min_similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """``bucket, id`` of the lines under a key that could be linked, by length and counts of characters, over others under it.

    Two lines within the limit that share a key are in the same bucket; a line that could be linked to no other
    one under its key is in none. A bucket is named after its lines, so lines that meet under many keys are one bucket.
    """
    reach = MAX_EDITS if threshold is None else threshold
    places = np.uint64(len(keys).bit_length())
    if int(keys.max(initial=0)) >> (64 - int(places)):
        order = np.argsort(keys, kind="stable")
        held = keys[order]
    else:  # a key and its place fit one number, and numbers are sorted fast
        held = np.sort(keys << places | np.arange(len(keys), dtype=np.uint64))
        order = (held & ((np.uint64(1) << places) - np.uint64(1))).astype(np.int64)
        held >>= places
    same = np.append(held[1:] == held[:-1], False)
    same[1:] |= same[:-1]
    order = order[same]
    # Few bits of an id travel, so lines that only look alike in them stay apart by what else is known.
    line = tokens.mix(ids[order] ^ tokens.mix(size[order].astype(np.uint64) << np.uint64(32) | sketch[order]))
    by_line = np.lexsort((~own[order], line, keys[order]))
    order, line = order[by_line], line[by_line]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(keys[order]) != 0) | (np.diff(line) != 0)
    order = order[new]
    # Lines of one key can be linked only if a chain of lengths leads from one to the other.
    order = order[np.lexsort((size[order], keys[order]))]
    keys, ids, own, size, sketch = keys[order], ids[order], own[order], size[order].astype(np.int64), sketch[order]
    begins = np.ones(len(keys), dtype=bool)
    begins[1:] = (np.diff(keys) != 0) | (np.diff(size) > reach)
    first = np.flatnonzero(begins)
    n = np.diff(np.append(first, len(keys)))
    useful = (n > 1) & (np.add.reduceat(own, first, dtype=np.int64) > 0 if len(first) else n > 1)
    into = np.arange(len(keys))
    large = np.repeat(useful & (n > PAIRED), n)
    into[large] = np.repeat(first, n)[large]
    first, n = first[useful & (n <= PAIRED)], n[useful & (n <= PAIRED)]
    counts = (sketch[:, None] >> (4 * np.arange(SKETCH, dtype=np.uint32)) & np.uint32(15)).astype(np.uint8)
    for i, j in _tiles(first, n, first, n, True):
        most = _limits(size[j], threshold, min_similarity)  # the j-th is the longer one
        near = (own[i] | own[j]) & (size[j] - size[i] <= most) & (most > 0)
        i, j, most = i[near], j[near], most[near]
        apart = (counts[i] - counts[j]) & 15
        near = np.minimum(apart, 16 - apart).sum(axis=1) + size[j] - size[i] <= 2 * most
        i, j = i[near], j[near]
        while (differ := into[i] != into[j]).any():
            i, j = i[differ], j[differ]
            np.minimum.at(into, np.maximum(into[i], into[j]), np.minimum(into[i], into[j]))
            while ((up := into[into]) != into).any():
                into = up
    keep = np.flatnonzero(np.bincount(into, minlength=len(into))[into] > 1)
    keep = keep[np.argsort(into[keep], kind="stable")]
    first = np.flatnonzero(np.diff(into[keep], prepend=-1))
    name = np.add.reduceat(tokens.mix(ids[keep]), first) if len(first) else np.empty(0, np.uint64)
    return np.repeat(name, np.diff(np.append(first, len(keep)))), ids[keep]


def _shared_keys(lines: DataFrame, threshold: int | None, min_similarity: float, bits: int, short_bits: int) -> DataFrame:
    """``bucket, short``: of the lines ``id, line_text``, those that share a key with one they could be linked to.

    ``short`` stands for the upper ``short_bits`` bits of ``id``; keys are dealt to ``2 ** bits`` ranges.
    """
    fields = ["range", "keys", "ids", "own", "sizes", "sketches"]
    key_bits = min(64, bits + packed.RANGE_KEYS.bit_length() - 1 + KEY_SPARE)
    within = np.uint64((1 << (key_bits - bits)) - 1)

    def demand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy().view(np.uint64) >> np.uint64(64 - short_bits)
            data, offsets = tokens.binary_column(batch, "line_text")
            for first, last, part, own in tokens.chunks(data, offsets, CHUNK_BYTES):
                # Characters of each line, none of which is empty: bytes that do not continue a character.
                size = np.add.reduceat((part & 0xC0) != 0x80, own[:-1], dtype=np.int64)
                by_size = np.argsort(size, kind="stable")
                size, line, raw = size[by_size], ids[first:last][by_size], part.tobytes()
                text = b"".join([raw[a:b] for a, b in zip(own[:-1][by_size].tolist(), own[1:][by_size].tolist())]).decode()
                code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
                keys, owner, mine = segment_keys(code, size, threshold, min_similarity)
                sketch = _sketches(code, size)
                keys >>= np.uint64(64 - key_bits)
                order = np.argsort(keys)
                keys, owner, mine = keys[order], owner[order], mine[order]
                line, size, sketch = line[owner], np.minimum(size[owner], 0xFFFF), sketch[owner]
                numbers, cuts = packed.slices(keys, bits, key_bits)
                keys &= within  # a row names its range
                parts = [slice(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                columns = [[packed.pack(keys[x]) for x in parts], [packed.pack_counts(line[x]) for x in parts], [np.packbits(mine[x]).tobytes() for x in parts], [packed.pack_counts(size[x]) for x in parts], [sketch[x].tobytes() for x in parts]]
                yield pa.RecordBatch.from_arrays([pa.array(numbers), *[pa.array(x, pa.binary()) for x in columns]], fields)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def shared() -> pa.RecordBatch:
            bucket, line = _buckets(*(np.concatenate(x) for x in zip(*held)), threshold, min_similarity)
            return pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(line.view(np.int64))], ["bucket", "short"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in fields)):
                if row[0] != current and held:
                    yield shared()
                    held = []
                current = row[0]
                keys = packed.unpack(row[1])
                own = np.unpackbits(np.frombuffer(row[3], np.uint8), count=len(keys)).astype(bool)
                held.append((keys, packed.unpack_counts(row[2]).view(np.uint64), own, packed.unpack_counts(row[4]).astype(np.uint16), np.frombuffer(row[5], np.uint32)))
        if held:
            yield shared()

    sent = lines.mapInArrow(frugal(demand), "range bigint, keys binary, ids binary, own binary, sizes binary, sketches binary")
    return sent.repartition("range").sortWithinPartitions("range").mapInArrow(frugal(match), "bucket bigint, short bigint")


def banded_distance(a: str, b: str, limit: int) -> int:
    """Edit distance of two strings if at most ``limit``, else ``limit`` + 1.

    Bit-parallel over a diagonal band: one word holds the ``2 * limit + 1`` cells of a column that can still
    matter (for limits up to 31), so a column costs a few word operations whatever the strings' length.
    """
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    # What both begin or end with does not count; near copies are mostly that.
    n, low, step = min(len(a), len(b)), 0, 64
    while low < n and step:
        if low + step <= n and a[low : low + step] == b[low : low + step]:
            low += step
        else:
            step //= 2
    a, b = a[low:], b[low:]
    n, low, step = min(len(a), len(b)), 0, 64
    while low < n and step:
        if low + step <= n and a[len(a) - low - step : len(a) - low] == b[len(b) - low - step : len(b) - low]:
            low += step
        else:
            step //= 2
    a, b = a[: len(a) - low], b[: len(b) - low]
    if not a or not b:
        return min(limit + 1, max(len(a), len(b)))
    # The recurrence of Myers in a window of WORD cells that follows the diagonal: bit k of a column
    # stands for row ``column + limit + 1 - WORD + k`` of the longer string, so the top bit is the band's edge.
    if len(a) < len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | (1 << (i + WORD))
    full, top = (1 << WORD) - 1, 1 << (WORD - 1)
    down, up = full & ~((1 << (WORD - limit - 1)) - 1), 0
    score, edge = min(limit, len(a)), 1 << (WORD - 2 - max(0, limit - len(a)))
    hopeless = 2 * limit + len(b) - len(a)
    for j, c in enumerate(b):
        match = (places.get(c, 0) >> (j + limit + 1)) & full
        diagonal = ((((match & down) + down) & full) ^ down) | match | up
        right, left = up | (full & ~(diagonal | down)), diagonal & down
        if j < len(a) - limit:
            score += not diagonal & top
        else:  # the band's edge has reached the last row
            score += bool(right & edge) - bool(left & edge)
            edge >>= 1
        if score > hopeless:
            return limit + 1
        down, up = left | (full & ~((diagonal >> 1) | right)), (diagonal >> 1) & right
    return min(score, limit + 1)


def _send(found: DataFrame):
    """Puts a line to each of its tasks; a bitmap of fixed size keeps most lines that no task wants out of the shuffle."""
    lines = found.select("id", F.col("line_text").alias("payload"))

    def send(tasks: DataFrame) -> DataFrame:
        tasks = written(tasks, "lines-tasks")
        wanted = test_bit(bitmap_literal(tasks.select(F.xxhash64("id").alias("h"))), F.xxhash64("id"))
        return tasks.join(lines.where(wanted), "id").select(*TASKS, "payload")

    return send


@dataclass(frozen=True)
class _Lines:
    """Lines of one side: their characters end to end, where each begins, its length, and its counts of letters."""

    code: np.ndarray
    start: np.ndarray
    size: np.ndarray
    letters: np.ndarray


def _read(payloads: list[bytes]) -> _Lines:
    code = np.frombuffer(b"".join(payloads).decode().encode("utf-32-le"), dtype=np.uint32)
    raw = np.frombuffer(b"".join(payloads), dtype=np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(p) for p in payloads])])
    upto = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[ends]
    owner = np.repeat(np.arange(len(payloads)), np.diff(upto))
    letters = np.bincount(owner * LETTERS + code % LETTERS, minlength=len(payloads) * LETTERS).reshape(-1, LETTERS)
    return _Lines(code, upto[:-1], np.diff(upto), np.minimum(letters, 255).astype(np.int16))


def _trimmed(lines: _Lines, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of both lines of each pair without what they begin and end with alike."""
    a, n, b, m = lines.start[i].copy(), lines.size[i].copy(), lines.start[j].copy(), lines.size[j].copy()
    for backward in (False, True):
        going = np.flatnonzero((n > 0) & (m > 0))
        width = 8
        while len(going):
            shift = np.arange(width)
            at = (n[going, None] - 1 - shift, m[going, None] - 1 - shift) if backward else (shift[None, :], shift[None, :])
            inside = (shift < n[going, None]) & (shift < m[going, None])
            same = inside & (lines.code[np.where(inside, a[going, None] + at[0], 0)] == lines.code[np.where(inside, b[going, None] + at[1], 0)])
            run = np.where(same.all(axis=1), width, same.argmin(axis=1))
            n[going] -= run
            m[going] -= run
            if not backward:
                a[going] += run
                b[going] += run
            going = going[(run == width) & (n[going] > 0) & (m[going] > 0)]
            width = min(2 * width, 64)
    return a, n, b, m


def banded_within(lines: _Lines, i: np.ndarray, j: np.ndarray, limit: int) -> np.ndarray:
    """Whether the lines of each pair are within ``limit`` edits: ``banded_distance`` for many pairs in step.

    A column of all pairs costs a few operations on arrays of 64-bit words. Pairs leave when their lines end or
    when the limit is out of reach.
    """
    a, n, b, m = _trimmed(lines, i, j)
    swap = n < m
    a, n, b, m = np.where(swap, b, a), np.where(swap, m, n), np.where(swap, a, b), np.where(swap, n, m)
    out = np.zeros(len(i), dtype=bool)
    text = lines.code
    easy = (m == 0) | (n - m > limit)
    out[easy] = (n <= limit)[easy] & (n - m <= limit)[easy]
    pair = np.flatnonzero(~easy)
    a, n, b, m = a[pair], n[pair], b[pair], m[pair]
    one = np.uint64(1)
    top = one << np.uint64(WORD - 1)
    down = np.full(len(pair), ~((one << np.uint64(WORD - limit - 1)) - one), dtype=np.uint64)
    up = np.zeros(len(pair), dtype=np.uint64)
    score = np.minimum(limit, n)
    edge = one << (WORD - 2 - np.maximum(0, limit - n)).astype(np.uint64)
    hopeless = 2 * limit + m - n
    reach = np.arange(-limit, limit + 1)
    place = one << (WORD - 1 - limit + reach).astype(np.uint64)
    column = 0
    while len(pair):
        rows = column + reach
        inside = (rows >= 0) & (rows < n[:, None])
        same = inside & (text[np.where(inside, a[:, None] + rows, 0)] == text[b + column][:, None])
        match = np.bitwise_or.reduce(np.where(same, place, np.uint64(0)), axis=1)
        diagonal = (((match & down) + down) ^ down) | match | up
        right_, left_ = up | ~(diagonal | down), diagonal & down
        last_row = column >= n - limit
        step = np.where(last_row, ((right_ & edge) != 0).astype(np.int64) - ((left_ & edge) != 0), (diagonal & top) == 0)
        score = score + step
        edge = np.where(last_row, edge >> one, edge)
        down, up = left_ | ~((diagonal >> one) | right_), (diagonal >> one) & right_
        column += 1
        ended = column >= m
        out[pair[ended & (score <= limit)]] = True
        stay = ~ended & (score <= hopeless)
        if not stay.all():
            pair, a, n, b, m, down, up, score, edge, hopeless = (x[stay] for x in (pair, a, n, b, m, down, up, score, edge, hopeless))
    return out


def _compare(threshold: int | None, min_similarity: float) -> tuple:
    """How lines are read and compared, all pairs of two blocks at once."""

    def limits(size: np.ndarray) -> np.ndarray:
        return _limits(size, threshold, min_similarity)

    def possible(lines: _Lines, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs whose lengths and counts of letters are within the limit: an edit changes two counts by one, or a count and the length."""
        most = limits(np.maximum(lines.size[i], lines.size[j]))
        out = (most > 0) & (np.abs(lines.size[i] - lines.size[j]) <= most)
        left = np.flatnonzero(out)
        for k in range(0, len(left), PAIRS):
            at = left[k : k + PAIRS]
            longer = np.abs(lines.size[i[at]] - lines.size[j[at]])
            out[at] = np.abs(lines.letters[i[at]] - lines.letters[j[at]]).sum(axis=1) + longer <= 2 * most[at]
        return out

    def linked(lines: _Lines, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        most = limits(np.maximum(lines.size[i], lines.size[j]))
        out = np.zeros(len(i), dtype=bool)
        for limit in np.unique(most).tolist():
            at = np.flatnonzero(most == limit)
            # Pairs of like length end together.
            at = at[np.argsort(np.minimum(lines.size[i[at]], lines.size[j[at]]), kind="stable")]
            for k in range(0, len(at), STEP_PAIRS):
                some = at[k : k + STEP_PAIRS]
                out[some] = banded_within(lines, i[some], j[some], limit)
        return out

    return _read, Pairwise(possible, linked)


def line_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int | None = THRESHOLD, min_similarity: float = MIN_SIMILARITY, row_col: str | None = None
) -> DataFrame:
    """``row, doc_id, line_no, line, class_id, near, kept`` of every line that is not blank.

    Lines end at line feeds; white space around them does not count. Equal lines, and lines within
    ``threshold`` edits that agree in ``min_similarity`` of the longer one, are linked; without a threshold
    the limit grows with the longer line (``edit_limit``). ``class_id`` is the smallest line hash reachable
    over links. The first line of a class (smallest row, then line number) is
    kept; ``near`` marks lines that differ from it. Missing and empty texts have no lines.
    """
    if threshold is not None and not 0 < threshold <= 31:
        raise ValueError("threshold must be from 1 to 31")
    if row_col is None:
        docs, row_col = with_rows(docs, id_col, "lines-rows")
    rows = texts(docs, id_col, text_col, docs[row_col].cast("bigint").alias("row"))
    ids = rows.select("row", "doc_id")
    rows = rows.select("row", "text")
    lines = written(line_table(rows), "lines-table")
    most = MAX_EDITS if threshold is None else threshold
    distinct = lines.where("line_text is not null").select(F.col("line").alias("id"), "line_text")
    keys_per_line = (most + 1) * (most + 4) // 3
    count = lines.count()  # a few more than are distinct, and no text is read
    short_bits = min(56, max(32, -(-(count.bit_length() + SHORT_SPARE) // 8) * 8))
    met = _shared_keys(distinct, threshold, min_similarity, packed.range_bits(count * keys_per_line), short_bits)
    shared = written(met.distinct(), "lines-shared")
    # A bitmap of fixed size keeps most lines that meet no other one from being dealt again; the join drops the others.
    short = F.shiftrightunsigned("id", 64 - short_bits).alias("short")
    known = test_bit(bitmap_literal(shared.select(F.xxhash64("short").alias("h")), KNOWN_BITS), F.xxhash64(short), KNOWN_BITS)
    dealt = distinct.where(known).withColumn("short", short).join(shared.select("short").distinct(), "short", "left_semi")
    found = written(dealt.dropDuplicates(["short", "id"]), "lines-texts")
    members = shared.join(found.select("id", "short"), "short").select("bucket", "id")
    classes = linked_classes(members, _send(found), *_compare(threshold, min_similarity), "lines")
    marked = lines.join(classes.withColumnRenamed("id", "line"), "line", "left").withColumn("class_id", F.coalesce("component", "line"))
    marked = written(marked.select("row", "line_no", "line", "class_id"), "lines-marked")
    firsts = written(marked.groupBy("class_id").agg(F.min(F.struct("row", "line_no", "line")).alias("first")), "lines-firsts")
    kept = (F.col("first.row") == F.col("row")) & (F.col("first.line_no") == F.col("line_no"))
    judged = marked.join(firsts, "class_id").select("row", "line_no", "line", "class_id", (F.col("first.line") != F.col("line")).alias("near"), kept.alias("kept"))
    # Where the id tells rows apart it is the row.
    return judged.withColumn("doc_id", F.col("row")) if row_col == id_col else judged.join(ids, "row")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all its columns, without lines that are not the first of their class; blank lines stay."""
    rows, number = with_rows(docs, id_col, "lines-rows")
    gone = line_classes(rows, id_col, text_col, row_col=number, **options).where("not kept").groupBy("row").agg(F.collect_set("line_no").alias("__gone"))
    gone = gone.withColumnRenamed("row", "__gone_row")
    joined = rows.join(gone, rows[number] == gone["__gone_row"], "left")
    left = F.filter(F.split(rows[text_col], "\n"), lambda _, i: ~F.array_contains("__gone", i))
    text = F.when(F.col("__gone").isNull(), rows[text_col]).otherwise(F.array_join(left, "\n"))
    return joined.select(*[text.alias(c) if c == text_col else rows[c] for c in docs.columns])


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = line_classes(docs, threshold=None)
    per_doc = lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if("kept").alias("n_kept"), F.count_if(~F.col("kept") & F.col("near")).alias("n_near"), F.count_if(~F.col("kept") & ~F.col("near")).alias("n_exact")
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_lines", "n_kept", "n_near", "n_exact")]
    return docs.select("doc_id").join(per_doc.withColumnRenamed("doc_id", "__id"), F.col("doc_id").eqNullSafe(F.col("__id")), "left").select("doc_id", *counts)
