"""Sorted 64-bit keys that travel packed: one row for each chunk and key range instead of one for each key.

Keys are dealt by their top bits, so a chunk's sorted keys fall into slices that follow each other. A key
is in a chunk's slices once, however often the chunk has it: frequent keys weigh no more than rare ones.
"""

from __future__ import annotations

import numpy as np

#: Keys that one range is to hold in all, about: few enough that a task's range and the rows that bring it are small.
RANGE_KEYS = 1 << 18


def range_bits(keys: float) -> int:
    """Top bits that tell ranges apart for about so many keys."""
    return max(0, int(np.ceil(np.log2(max(1.0, keys / RANGE_KEYS)))))


def slices(keys: np.ndarray, bits: int, width: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the ranges that sorted keys of ``width`` bits fall in, and where each begins (one more at the end)."""
    at = (keys >> np.uint64(width - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], np.append(first, len(keys))


def _planes(values: np.ndarray) -> bytes:
    """The byte planes of 64-bit values up to the highest that is not all zeros, one at least, and their number before them."""
    used = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([used]) + np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T[:used]).tobytes()


def _values(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, : len(planes)] = planes.T
    return out.view(np.uint64).ravel()


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte planes apart; the upper planes, all zeros, are left out."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(_values(raw), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts as planes of bytes; most are small and take one or two bytes each."""
    return _planes(counts.astype(np.uint64))


def unpack_counts(raw: bytes) -> np.ndarray:
    return _values(raw).view(np.int64)
