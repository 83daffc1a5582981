"""Pairs of large tasks, a part at a time."""

from __future__ import annotations

import numpy as np
import pytest

from oreline.llm import lines, links

from . import brute
from .fixtures import frame


@pytest.mark.parametrize("limit", [1, 5, 1000])
def test_tiles_hold_every_pair_once(monkeypatch, limit):
    monkeypatch.setattr(links, "TOGETHER_PAIRS", limit)
    first, n, second, m = (np.array(x, np.int64) for x in ([0, 9, 30], [3, 0, 4], [3, 9, 34], [2, 5, 6]))
    tiles = list(links._tiles(first, n, second, m, False))
    want = [(a, b) for f, k, s, q in zip(first, n, second, m) for a in range(f, f + k) for b in range(s, s + q)]
    assert sorted((a, b) for i, j in tiles for a, b in zip(i.tolist(), j.tolist())) == sorted(want)
    assert max(len(i) for i, _ in tiles) <= limit + 6
    tiles = list(links._tiles(first, n, first, n, True))
    want = [(a, b) for f, k in zip(first, n) for a in range(f, f + k) for b in range(a + 1, f + k)]
    assert sorted((a, b) for i, j in tiles for a, b in zip(i.tolist(), j.tolist())) == sorted(want)


def test_a_bucket_travels_few_times(spark, monkeypatch):
    """Lines that share a segment and are not linked go to blocks as wide as a task's pairs allow, with the same classes."""
    monkeypatch.setattr(links, "BLOCK", 6)
    monkeypatch.setattr(links, "TOGETHER_PAIRS", 100)
    sent, blocks = [], links._blocks
    monkeypatch.setattr(links, "_blocks", lambda *args: sent.append(blocks(*args)) or sent[-1])
    shared = "a segment that all lines share "
    texts = [shared + "".join(chr(97 + (i * 7 + k * k * (i + 3)) % 26) for k in range(29)) for i in range(40)]
    texts += [t[:-1] + "!" for t in texts[:8]]
    docs = [(i, t) for i, t in enumerate(texts)]
    got = lines.line_classes(frame(spark, docs)).select("doc_id", "class_id").collect()
    classes: dict[int, set[int]] = {}
    for r in got:
        classes.setdefault(r.class_id, set()).add(r.doc_id)
    linked = {(i, j) for i in range(48) for j in range(i) if brute.edit(texts[i], texts[j]) <= 2}
    parent = list(range(48))
    for i, j in linked:
        a, b = parent[i], parent[j]
        parent = [b if p == a else p for p in parent]
    want: dict[int, set[int]] = {}
    for i, p in enumerate(parent):
        want.setdefault(p, set()).add(i)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, want.values())) and linked
    for tasks in sent:
        assert tasks.groupBy("k1", "id").count().agg({"count": "max"}).first()[0] == 1
    assert sent


def test_only_lines_alike_are_candidates(spark, monkeypatch):
    """Lines that share a segment and differ in all else meet nobody; near copies among them do, with the classes of all pairs."""
    rng = np.random.default_rng(6)
    say = lambda letters: "".join(rng.choice(list(letters), 90))
    texts = ["a segment that all lines share, " + say("bcdfghjk" if i % 2 else "lmnpqrst") for i in range(40)]
    apart = [(i, j) for i in range(40) for j in range(i) if i % 2 != j % 2]
    assert all(brute.edit(texts[i], texts[j]) > lines.MAX_EDITS for i, j in apart[:20])
    texts = texts[:2] + [texts[0][:60] + "#" + texts[0][61:], texts[1][:70] + texts[1][71:]]
    seen, solve = [], lines.linked_classes
    monkeypatch.setattr(lines, "linked_classes", lambda members, *rest: seen.append(members) or solve(members, *rest))
    got = {r.doc_id: r.class_id for r in lines.line_classes(frame(spark, list(enumerate(texts))), threshold=None).collect()}
    assert got[0] == got[2] != got[1] == got[3]
    buckets: dict[int, set[int]] = {}
    for r in seen[0].collect():
        buckets.setdefault(r.bucket, set()).add(r.id)
    assert sorted({len(b) for b in buckets.values()}) == [2] and len({frozenset(b) for b in buckets.values()}) == 2


@pytest.mark.parametrize("paired", [2, 1000])
def test_buckets_keep_every_pair_within_the_limit(monkeypatch, paired):
    """Lines of a key that sketches allow to be linked stay together, also where a key has too many to pair."""
    monkeypatch.setattr(lines, "PAIRED", paired)
    rng = np.random.default_rng(7)
    n = 400
    keys, ids = rng.integers(0, 40, n).astype(np.uint64), rng.integers(0, 90, n).astype(np.uint64)
    size_of, code_of = np.sort(rng.integers(60, 90, 90)), rng.integers(97, 100, 90 * 90).astype(np.uint32)
    code = np.concatenate([code_of[i * 90 : i * 90 + k] for i, k in enumerate(size_of)])
    sketch, size, own = lines._sketches(code, size_of)[ids.astype(int)], size_of[ids.astype(int)], rng.random(n) < 0.6
    bucket, line = lines._buckets(keys, ids, own, size.astype(np.uint16), sketch, None, 0.8)
    got: dict[int, set[int]] = {}
    for b, i in zip(bucket.tolist(), line.tolist()):
        got.setdefault(b, set()).add(i)
    where: dict[int, list[set[int]]] = {}
    for members in got.values():
        for i in members:
            where.setdefault(i, []).append(members)
    counts = [np.bincount(code[a:b] % 32, minlength=32) for a, b in zip(np.cumsum(size_of) - size_of, np.cumsum(size_of))]
    linked = 0
    for x in range(n):
        for y in range(x):
            i, j = int(ids[x]), int(ids[y])
            limit = lines.edit_limit(int(max(size_of[i], size_of[j])), None, 0.8)
            if i != j and keys[x] == keys[y] and (own[x] or own[y]) and abs(counts[i] - counts[j]).sum() <= limit and abs(size_of[i] - size_of[j]) <= limit:
                linked += 1
                assert any(j in members for members in where.get(i, []))
    assert linked > 20 and all(len(members) > 1 for members in got.values())


def test_lines_under_many_keys_are_one_bucket():
    """The same lines under five keys have one name; a line of the same few id bits but another sketch is not taken for one."""
    keys, ids = np.repeat(np.arange(5), 3).astype(np.uint64), np.tile([7, 8, 9], 5).astype(np.uint64)
    same, zeros = np.full(15, 80, np.uint16), np.zeros(15, np.uint32)
    bucket, line = lines._buckets(keys, ids, np.ones(15, bool), same, zeros, None, 0.8)
    assert len(set(bucket.tolist())) == 1 and sorted(line.tolist()) == sorted(ids.tolist())
    keys, ids, own = np.zeros(3, np.uint64), np.array([7, 7, 8], np.uint64), np.ones(3, bool)
    sketch = np.array([0x11111111, 0, 0], np.uint32) * np.uint32(7)
    for k in ([0, 1, 2], [1, 0, 2]):
        bucket, line = lines._buckets(keys, ids[k], own, np.full(3, 80, np.uint16), sketch[k], None, 0.8)
        assert sorted(line.tolist()) == [7, 8]


def test_lengths_count_among_the_characters():
    """Six characters more and seven others changed are beyond six edits, though each by itself is not."""
    code = np.frombuffer(("a" * 80 + "a" * 73 + "b" * 13).encode("utf-32-le"), np.uint32)
    size = np.array([80, 86])
    sketch = lines._sketches(code, size)
    args = np.zeros(2, np.uint64), np.arange(2).astype(np.uint64), np.ones(2, bool), size.astype(np.uint16)
    assert lines.edit_limit(86, None, 0.8) == 7 and len(lines._buckets(*args, sketch, None, 0.8)[0]) == 0
    code = np.frombuffer(("a" * 80 + "a" * 79 + "b" * 7).encode("utf-32-le"), np.uint32)
    assert len(lines._buckets(*args, lines._sketches(code, size), None, 0.8)[0]) == 2


def test_open_buckets_of_a_leader_are_one(spark):
    """Buckets of like members are taken as one, those with little in common stay apart, and no pair of a bucket is lost."""
    alike = {1: [1, 2, 3, 4], 2: [1, 2, 3, 5], 3: [1, 3, 4, 5]}
    other = {4: [10, 11, 12], 5: [10, 13, 14], 6: [10, 15, 16]}
    rows = [(b, len(m), i, i, m[0]) for b, m in (alike | other).items() for i in m]
    rest = spark.createDataFrame(rows, "bucket bigint, n bigint, id bigint, component bigint, leader bigint")
    got: dict[int, set[int]] = {}
    for r in links._families(rest).collect():
        got.setdefault(r.bucket, set()).add(r.id)
        assert r.component == r.id
    assert sorted(map(sorted, got.values())) == [[1, 2, 3, 4, 5], [10, 11, 12], [10, 13, 14], [10, 15, 16]]
    for members in (alike | other).values():
        assert any(set(members) <= g for g in got.values())
