"""Words of a batch of texts as numpy arrays, without a Python object per word.

A batch is the data and offsets of an Arrow binary column. Work goes through it in chunks of
whole documents of about ``CHUNK_BYTES``, so memory stays bounded by one chunk or one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15 | 5
_MASK = (1 << 64) - 1

#: Lower-case A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words that white space separates: all but space and 0x09-0x0D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: Bytes of words made of ASCII letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash's multiplier and of its inverse, at least."""
    if len(_POWERS[0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        for slot, base in ((0, _MULTIPLIER), (1, pow(_MULTIPLIER, -1, 1 << 64))):
            steps = np.full(n, base & _MASK, dtype=np.uint64)
            steps[0] = 1
            _POWERS[slot] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


def binary_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Data bytes and offsets of a binary column; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[ends[0] : ends[-1]] if len(ends) else raw, ends - ends[0] if len(ends) else np.zeros(1, np.int64)


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents: first, one past the last, their bytes, offsets within these."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        last = min(last, n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and where each document's words begin among them."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = in_word[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def slice_hasher(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Function from starts and ends to the 64-bit hash of each ``data[start:end]``, whatever its place in the data."""
    power, inverse = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])

    def hashes(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    return hashes


def hash_slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return slice_hasher(data)(starts, ends)


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words (shorter by n - 1 than ``words``)."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        out *= np.uint64(0x9FB21C651E98DF25)
        out ^= words[i : len(words) - n + 1 + i]
        out ^= out >> np.uint64(29)
    return mix(out)


def runs_inside(bounds: np.ndarray, n: int) -> np.ndarray:
    """Positions (in the concatenated words) at which a run of ``n`` words stays in one document."""
    total = int(bounds[-1])
    if total < n:
        return np.empty(0, np.int64)
    ok = np.ones(total - n + 1, dtype=bool)
    for shift in range(1, n):
        at = bounds[1:-1] - shift
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return np.flatnonzero(ok)
