"""What tasks hold in memory."""

from __future__ import annotations

import os
import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import zstandard

from oreline.llm import collocations, ngrams, packed, repeats, tokens


def test_packed_values_come_back():
    for keys in ([], [0], [0, 0, 1 << 40, (1 << 64) - 1]):
        keys = np.array(keys, np.uint64)
        assert packed.unpack(packed.pack(keys)).tolist() == keys.tolist()
    for counts in ([], [0, 0], [1, 255, 256, 1 << 50]):
        counts = np.array(counts, np.int64)
        back = packed.unpack_counts(packed.pack_counts(counts))
        assert back.tolist() == counts.tolist() and back.dtype == np.int64


def test_packed_planes_of_zeros_take_no_room():
    """Rows of a shuffle are held by tasks as they are, not as they are compressed."""
    assert len(packed.pack_counts(np.ones(1000, np.int64))) <= 1001
    grams = np.sort(np.random.default_rng(1).integers(0, 1 << 40, 1000, dtype=np.uint64))
    assert len(packed.pack(grams)) <= 5001


def chunk(documents: list[bytes]) -> tuple[pa.ListScalar, pa.Scalar]:
    ends = np.cumsum([len(d) for d in documents]).tolist()
    return pa.array([ends], pa.list_(pa.int64()))[0], pa.array([zstandard.ZstdCompressor().compress(b"".join(documents))], pa.binary())[0]


def test_chunks_open_alike_in_parts(monkeypatch):
    ends, body = chunk([b"", b"one two", b"three", b"", b"x" * 50, b"  a B \tc ", b""])
    words, bounds = ngrams._open(ends, body)
    assert bounds.tolist() == [0, 0, 2, 3, 3, 4, 7, 7]
    for size in (1, 8, 60):
        monkeypatch.setattr(ngrams, "HASH_BYTES", size)
        again, begins = ngrams._open(ends, body)
        assert again.tolist() == words.tolist() and begins.tolist() == bounds.tolist()


def test_chunks_open_in_little_memory(monkeypatch):
    monkeypatch.setattr(tokens, "_POWERS", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    rng = np.random.default_rng(2)
    documents = [b" ".join(b"w%d" % w for w in rng.integers(0, 50_000, 300)) for _ in range(2200)]
    ends, body = chunk(documents)
    tracemalloc.start()
    ngrams._open(ends, body)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, documents)) > 3.5e6 and peak < 100e6


def test_words_cut_out_of_a_chunk():
    data = np.frombuffer(b"ab c  def", np.uint8)
    assert collocations._cut(data, np.array([6, 0, 3]), np.array([9, 2, 4])).to_pylist() == [b"def", b"ab", b"c"]
    assert collocations._cut(data[:0], np.empty(0, np.int64), np.empty(0, np.int64)).to_pylist() == []


def test_counting_keeps_little_when_it_ends():
    """A worker that counted n-grams waits for its next task without the memory it needed."""
    code = f"""
import sys; sys.path.insert(0, {os.getcwd()!r})
import re, numpy as np, pyarrow as pa
from pyspark import cloudpickle
from oreline.llm import collocations
from oreline.llm.common import frugal
held = lambda: sum(map(int, re.findall(r"Private_Dirty: +([0-9]+)", open("/proc/self/smaps_rollup").read()))) >> 10
rng = np.random.default_rng(1)
def batch():
    texts = [" ".join("w%d" % w for w in rng.integers(0, 50_000, 300)) for _ in range(6000)]
    return pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array([t.encode() for t in texts])], ["lang", "text"])
count = frugal(collocations._dealt_counts((1, 2), None, 2 << 20, 8))
sum(out.num_rows for out in count([batch()]))
print(held(), pa.default_memory_pool().max_memory() >> 20)
"""
    kept, most = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())
    assert most < 170 and kept < 240, (kept, most)


class _Plain:
    """Keeps the function given to ``mapInArrow``."""

    def mapInArrow(self, work, fields):
        self.work = work
        return self


def test_packed_strings_are_hashed_in_parts(monkeypatch):
    """A block of packed strings is hashed a part at a time, with the masks of the whole block."""
    texts = [" ".join(f"w{(i * 31 + k * k) % 97}" for k in range(20)) for i in range(40)] + [" ".join(f"w{k}" for k in range(20))] * 2
    n = len(texts)
    batch = pa.record_batch({"bucket": pa.array([7] * n), "packed": pa.array([t.encode() for t in texts]), "k1": pa.array(range(n)), "k2": pa.array(range(n)), "n": pa.array([1] * n)})
    whole = [r for b in repeats._count(_Plain(), 5).work(iter([batch])) for r in b.to_pylist()]
    sizes, hashes = [], tokens.hash_slices
    monkeypatch.setattr(tokens, "hash_slices", lambda data, *rest: sizes.append(len(data)) or hashes(data, *rest))
    monkeypatch.setattr(repeats, "PART_BYTES", 200)
    parts = [r for b in repeats._count(_Plain(), 5).work(iter([batch])) for r in b.to_pylist()]
    assert parts == whole and {40, 41} <= {r["k1"] for r in whole}
    assert len(sizes) > 10 and max(sizes) <= 200
