"""Connected classes from buckets of candidates, without emitting the pairs of a bucket.

Members of a bucket are compared with one leader first: the member that shares most buckets with others,
which in a group of near copies is the text the others vary. Classes are joined, and only buckets whose
members still lie in different classes are looked at again. Their members are dealt to blocks, every two
blocks meet in one task, and the task returns only links between classes. So a row travels once for each
block of its bucket, never once for each partner, and no pair that shares a bucket is left out unless its
members are in one class already. Open buckets of one leader mostly hold the same members, and are then
taken as one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected, frugal, written

#: Members in a block, about: a leader meets as many in one task, and two blocks meet in one.
BLOCK = 256
#: Blocks of a bucket hold so many times as many where pairs are compared many at once: a row then travels less often.
WIDE = 8

#: Rows of a task: its key, the side a row is on, the row, its class and what is compared.
TASK_FIELDS = "k1 bigint, k2 bigint, side int, component bigint, id bigint, payload binary"
TASKS = ["k1", "k2", "side", "component", "id"]
LEADER, MEMBER, INSIDE = 0, 1, 2
#: Pairs verified together; links found among them spare the pairs of their classes that come later.
PAIRS = 1 << 15
#: Pairs and bytes of the tasks that are solved together, about; a single task may have more.
TOGETHER_PAIRS, TOGETHER_BYTES = 1 << 19, 8 << 20


@dataclass(frozen=True)
class Pairwise:
    """Comparison of many pairs at once: of the pairs of places ``i, j`` of what was read, which could be linked,
    and which are."""

    possible: Callable[[Any, np.ndarray, np.ndarray], np.ndarray]
    linked: Callable[[Any, np.ndarray, np.ndarray], np.ndarray]


def linked_classes(
    members: DataFrame,
    send: Callable[[DataFrame], DataFrame],
    read: Callable[[list[bytes]], Any],
    partners: Callable[[Any, int, Any, list[int]], Iterator[int]] | Pairwise,
    label: str,
) -> DataFrame:
    """``id, component`` of the ids that are linked to another one; the component is the smallest id reachable.

    ``members`` has ``bucket, id``. ``send`` turns rows of ``TASKS`` into rows of ``TASK_FIELDS``. In a task
    ``read`` prepares the payloads of a side, and ``partners(left, i, right, places)`` gives, one after the
    other, which ``places`` of the right side are linked to the i-th of the left; a ``Pairwise`` answers for
    many pairs at once.
    """
    members = written(members, f"{label}-members")
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(members.join(sizes, "bucket"), f"{label}-shared")
    weights = written(members.groupBy("id").agg(F.sum("n").alias("weight")), f"{label}-weights")
    ranked = members.join(weights, "id").select("bucket", F.struct("weight", (-F.col("id")).alias("order")).alias("rank"))
    leaders = written(ranked.groupBy("bucket").agg((-F.max("rank")["order"]).alias("leader")), f"{label}-leaders")
    pairs = members.join(leaders, "bucket").where("id <> leader").select("leader", "id").distinct()
    edges = written(_links(_stars(written(pairs, f"{label}-pairs")), send, read, partners), f"{label}-edges")
    classes = connected(edges, f"{label}-components")

    placed = members.join(classes, "id", "left").select("bucket", "n", "id", F.coalesce("component", "id").alias("component"))
    # In a bucket of two both were compared when one led.
    placed = written(placed.where("n > 2"), f"{label}-placed")
    open_ = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    rest = written(placed.join(open_.join(leaders, "bucket"), "bucket"), f"{label}-rest")
    if rest.isEmpty():
        return classes
    block = BLOCK * WIDE if isinstance(partners, Pairwise) else BLOCK
    more = written(_links(_blocks(_families(rest), block), send, read, partners), f"{label}-more-edges")
    return classes if more.isEmpty() else connected(edges.union(more), f"{label}-components")


def _stars(pairs: DataFrame) -> DataFrame:
    """Tasks of a leader with a share of its members."""
    shares = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("shares"))
    share = F.pmod(F.hash("id"), "shares").cast("bigint")
    member = pairs.join(shares, "leader").select(F.col("leader").alias("k1"), share.alias("k2"), F.lit(MEMBER).alias("side"), F.col("id").alias("component"), "id")
    leader = shares.select(F.col("leader").alias("id"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares").cast("bigint") - 1)).alias("k2"))
    return leader.select(F.col("id").alias("k1"), "k2", F.lit(LEADER).alias("side"), F.col("id").alias("component"), "id").union(member)


def _families(rest: DataFrame) -> DataFrame:
    """``bucket, n, id, component`` of ``rest``, buckets of one leader as a single one where that has no more pairs.

    Texts that resemble each other share many buckets, mostly under one leader; so they are compared once and not
    once for each bucket. Buckets that have little but their leader in common stay apart.
    """
    members = rest.select("leader", "id", "component").distinct()
    sizes = members.groupBy("leader").agg(F.count(F.lit(1)).alias("n"))
    # A bucket of n has n rows: the sum of n over its rows is the square of n.
    apart = rest.groupBy("leader").agg(F.sum(F.col("n").cast("double")).alias("apart"))
    whole = sizes.join(apart, "leader").where(F.col("n").cast("double") * F.col("n") <= F.col("apart")).select("leader", "n")
    merged = members.join(whole, "leader").select(F.xxhash64("leader").alias("bucket"), "n", "id", "component")
    return merged.union(rest.join(whole, "leader", "left_anti").select("bucket", "n", "id", "component"))


def _blocks(rest: DataFrame, block: int | None = None) -> DataFrame:
    """Tasks of two blocks of a bucket, or of one block by itself."""
    count = F.ceil(F.col("n") / (block or BLOCK)).cast("int")
    dealt = rest.withColumn("blocks", count).withColumn("mine", F.pmod(F.hash("id", "bucket"), "blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return dealt.select("bucket", "id", "component", "blocks", "mine", other).select(
        F.col("bucket").alias("k1"),
        (F.least("mine", "other").cast("bigint") * F.col("blocks") + F.greatest("mine", "other")).alias("k2"),
        F.when(F.col("mine") == F.col("other"), INSIDE).when(F.col("mine") < F.col("other"), LEADER).otherwise(MEMBER).alias("side"),
        "component",
        "id",
    )


def _links(tasks: DataFrame, send, read, partners) -> DataFrame:
    """Links ``a, b`` found in the tasks, enough to connect what is linked."""

    def solve(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        parent: dict[int, int] = {}

        def root(i: int) -> int:
            while parent.get(i, i) != i:
                parent[i] = parent.get(parent[i], parent[i])
                i = parent[i]
            return i

        sides = {side: [r for r in rows if r[0] == side] for side in (LEADER, MEMBER, INSIDE)}
        for mine, theirs in ((sides[LEADER], sides[MEMBER]), (sides[INSIDE], sides[INSIDE])):
            if not mine or not theirs:
                continue
            left, right = read([r[3] for r in mine]), read([r[3] for r in theirs])
            inside = mine is theirs
            for i, (_, component, a, _) in enumerate(mine):
                apart = [j for j in range(i + 1 if inside else 0, len(theirs)) if root(theirs[j][1]) != root(component)]
                for j in partners(left, i, right, apart) if apart else ():
                    x, y = root(component), root(theirs[j][1])
                    if x != y:
                        parent[x] = y
                        yield a, theirs[j][2]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def flush() -> pa.RecordBatch:
            found = list(solve(rows))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("k1", "k2", "side", "component", "id", "payload")]
            for k1, k2, *row in zip(*columns):
                if (k1, k2) != key:
                    if rows:
                        yield flush()
                    key, rows = (k1, k2), []
                rows.append(tuple(row))
        if rows:
            yield flush()

    dealt = send(tasks).repartition("k1", "k2").sortWithinPartitions("k1", "k2")
    return dealt.mapInArrow(frugal(_compare_many(read, partners) if isinstance(partners, Pairwise) else compare), "a bigint, b bigint")


def _across(first: np.ndarray, n: np.ndarray, second: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of each task: ``n`` rows from ``first`` on with ``m`` rows from ``second`` on."""
    pairs = n * m
    task = np.repeat(np.arange(len(pairs)), pairs)
    at = np.arange(int(pairs.sum())) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    return first[task] + at // m[task], second[task] + at % m[task]


def _tiles(first: np.ndarray, n: np.ndarray, second: np.ndarray, m: np.ndarray, inside: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of each task as ``_across``, about ``TOGETHER_PAIRS`` at a time; ``inside`` each pair once."""
    left = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    start, size = np.repeat(second, n), np.repeat(m, n)
    if inside:
        size = size - (left + 1 - start)
        start = left + 1
    tile = np.cumsum(size) // TOGETHER_PAIRS
    for some in np.split(np.arange(len(left)), np.flatnonzero(np.diff(tile)) + 1):
        if size[some].any():
            yield _across(left[some], np.ones(len(some), np.int64), start[some], size[some])


def _compare_many(read: Callable[[list[bytes]], Any], how: Pairwise):
    """Function that solves many tasks together: most have a few rows, and pairs of all of them are compared in step."""

    def join(ok: np.ndarray, i: np.ndarray, j: np.ndarray, now: np.ndarray, ids: np.ndarray, found: list[tuple[int, int]]) -> np.ndarray:
        parent: dict[int, int] = {}

        def root(k: int) -> int:
            while parent.get(k, k) != k:
                parent[k] = parent.get(parent[k], parent[k])
                k = parent[k]
            return k

        for x, y in zip(i[ok].tolist(), j[ok].tolist()):
            one, two = root(int(now[x])), root(int(now[y]))
            if one != two:
                parent[one] = two
                found.append((int(ids[x]), int(ids[y])))
        if not parent:
            return now
        into = np.arange(int(now.max()) + 1)
        into[list(parent)] = [root(k) for k in parent]
        return into[now]

    def solve(task: np.ndarray, side: np.ndarray, component: np.ndarray, ids: np.ndarray, payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((side, task))
        task, side, component, ids = task[order], side[order], component[order], ids[order]
        held = read([payloads[k] for k in order.tolist()])
        counts = np.bincount(task * 3 + side, minlength=3 * (int(task[-1]) + 1)).reshape(-1, 3)
        begin = np.cumsum(counts.ravel()) - counts.ravel()
        begin = begin.reshape(-1, 3)
        _, now = np.unique(component, return_inverse=True)  # the class of each row, as links join them
        found: list[tuple[int, int]] = []
        sides = ((LEADER, MEMBER), (INSIDE, INSIDE))
        for i, j in (tile for x, y in sides for tile in _tiles(begin[:, x], counts[:, x], begin[:, y], counts[:, y], x == y)):
            apart = now[i] != now[j]
            i, j = i[apart], j[apart]
            fits = how.possible(held, i, j)
            i, j = i[fits], j[fits]
            while len(i):
                now = join(how.linked(held, i[:PAIRS], j[:PAIRS]), i[:PAIRS], j[:PAIRS], now, ids, found)
                i, j = i[PAIRS:], j[PAIRS:]
                apart = now[i] != now[j]
                i, j = i[apart], j[apart]
        return np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key, task, rows, pairs, size = None, -1, 0, 0, 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*held))
            a, b = solve(*[np.array(c, np.int64) for c in columns[:4]], columns[4])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("k1", "k2", "side", "component", "id", "payload")]
            for k1, k2, side, component, row, payload in zip(*columns):
                if (k1, k2) != key:
                    pairs += rows * rows // 4
                    if pairs >= TOGETHER_PAIRS or size >= TOGETHER_BYTES:
                        yield flush()
                        held, task, pairs, size = [], -1, 0, 0
                    key, task, rows = (k1, k2), task + 1, 0
                held.append((task, side, component, row, payload))
                rows, size = rows + 1, size + len(payload)
        if held:
            yield flush()

    return run
