"""Hard-negative mining over an STR-packed R-tree, operator 13.

Rows are sorted into tiles (cuts on the coordinates that vary most, fitted on a bounded sample) and packed in
that order into subtrees of a fixed number of rows, each a row of the written index with the bounding boxes of
its leaves. A box gives an interval of inner products for every coordinate, hence bounds for a whole query. A
query meets only the subtrees whose box can hold an answer, and inside one takes leaves best first from a queue
until the next box is outside its score windows or strictly below the kth score it has.

Queries are blocks of anchors. A task holds a deal of blocks and reads a group of subtrees one after the other, so
that a block travels once for each group and a subtree once for each deal. Answers of a subtree are at most k for a
query and window; the best k of all subtrees are taken by a window that Spark limits before the shuffle. Every row is
indexed and the result is exact.

Written tables repeat blocks and compress well, so their files say little about their rows in memory. Joins are
merge joins whatever the files' size: nothing that grows with the rows is broadcast from the driver.

Rows without id, label or vector, or with a null or non-finite component, take no part. Vectors of different
length are compared as if the shorter one ended in zeros. Rows that share an id are rows of their own: as anchors
each gets its own answers, and equal scores of one id stay in any order, which the result does not show. Scores
are exact; one that a long cannot hold is an error. No rows, no anchors or no second label give an empty result.
Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import frugal, table, written

#: Rows, and components in all, that the tiling is fitted on at most; every row is tiled and indexed.
SAMPLE_ROWS = 20_000
SAMPLE_VALUES = 1 << 21
#: Ranges of the index's order at most: the driver holds some 300 sort keys for each. A range holds any number of subtrees.
MAX_RANGES = 1000
#: Groups of subtrees that a search is dealt to before a group has more than one.
GROUPS = 128
#: Coordinates that tiles are cut on, and tiles at most: a tile beyond a subtree's rows is cut along the order of one more coordinate.
TILE_COORDINATES = 3
MAX_TILES = 2048
#: Sums of products below this are exact in a double.
EXACT = 1 << 53

#: Below every score, and its negative is a long too.
_NO_BOUND = np.iinfo(np.int64).min + 1


@dataclass(frozen=True)
class Shape:
    """Rows of a subtree and of a leaf, anchors of a block, boxes a query takes from its queue at a time, roots that a
    group has at most, and anchors that a task holds, about. Results do not depend on it."""

    subtree_rows: int = 4096
    leaf_rows: int = 64
    anchors: int = 128
    boxes: int = 8
    roots: int = 64
    held: int = 1 << 16

    def leaves(self, rows: int) -> int:
        return math.ceil(rows / self.leaf_rows)


def vectors(rows: DataFrame, vec_id: Column, label: Column, components: Column, anchor: Column) -> DataFrame:
    """``id, label, vector, anchor`` of the rows that take part; components must be whole numbers of type long."""
    known = rows.select(
        vec_id.cast("bigint").alias("id"), label.cast("bigint").alias("label"), components.alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor")
    )
    whole = ~F.exists("vector", lambda x: x.isNull())
    return known.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & whole)


# --- matrices of whole numbers


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix of longs; shorter ones end in zeros."""
    offsets = lists.offsets.to_numpy()
    flat = np.asarray(lists.values.to_numpy(zero_copy_only=False), dtype=np.int64)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    width = int(sizes.max()) if len(sizes) else 0
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def _pack(matrix: np.ndarray) -> bytes:
    """A matrix in the narrowest type that holds it, with its type and width in front."""
    for kind in ("<i2", "<i4", "<i8"):
        limit = np.iinfo(kind)
        if kind == "<i8" or not matrix.size or (limit.min <= matrix.min() and matrix.max() <= limit.max):
            return kind.encode() + int(matrix.shape[1]).to_bytes(4, "little") + matrix.astype(kind).tobytes()
    raise AssertionError


def _unpack(raw: bytes, rows: int) -> np.ndarray:
    width = int.from_bytes(raw[3:7], "little")
    return np.frombuffer(raw, dtype=raw[:3].decode(), offset=7).reshape(rows, width).astype(np.int64)


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates both have: beyond them one is zero."""
    width = min(a.shape[1], b.shape[1])
    return a[:, :width], b[:, :width]


def _largest(matrix: np.ndarray) -> int:
    return max(abs(int(matrix.max())), abs(int(matrix.min()))) if matrix.size else 0


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``, as longs."""
    a, b = _same_width(a, b)
    if a.shape[1] * _largest(a) * _largest(b) < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    if exact.size and not all(abs(int(x)) < 1 << 63 for x in exact.flat):
        raise OverflowError("an inner product is beyond 64 bits")
    return exact.astype(np.int64)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product each query can have with a point of each box, coordinate by coordinate.

    Where sums are not exact in a double the interval is widened by more than its error.
    """
    width = max(low.shape[1], high.shape[1])
    queries = queries[:, :width]
    low, high = low[:, : queries.shape[1]].astype(np.float64), high[:, : queries.shape[1]].astype(np.float64)
    up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    least, greatest = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    size = queries.shape[1] * _largest(queries) * max(np.abs(low).max(initial=0), np.abs(high).max(initial=0))
    slack = 0.0 if size < EXACT else size * 1e-12 + 1
    return least - slack, greatest + slack


# --- tiles and subtrees


def _tiles(sample: np.ndarray, tiles: int) -> tuple[list[int], list]:
    """Coordinates and nested cuts of sort-tile-recursive packing, fitted on the sample."""
    varying = np.argsort(-sample.astype(np.float64).var(axis=0), kind="stable")
    coordinates = [int(c) for c in varying[:TILE_COORDINATES]]

    def cut(rows: np.ndarray, depth: int, parts: int):
        if parts <= 1 or depth == len(coordinates):
            return None
        slabs = max(2, math.ceil(parts ** (1 / (len(coordinates) - depth))))
        values = np.sort(rows[:, coordinates[depth]])
        cuts = values[[len(values) * i // slabs for i in range(1, slabs)]] if len(values) else np.empty(0, np.int64)
        slab = np.searchsorted(cuts, rows[:, coordinates[depth]], side="right")
        return cuts, [cut(rows[slab == i], depth + 1, math.ceil(parts / slabs)) for i in range(slabs)]

    return coordinates, cut(sample, 0, tiles)


def _assign(rows: np.ndarray, coordinates: list[int], cuts, depth: int = 0) -> np.ndarray:
    """Number of the tile of each row; tiles are numbered in packing order."""
    if cuts is None:
        return np.zeros(len(rows), np.int64)
    values = rows[:, coordinates[depth]] if coordinates[depth] < rows.shape[1] else np.zeros(len(rows), np.int64)
    slab = np.searchsorted(cuts[0], values, side="right")
    out, first = np.zeros(len(rows), np.int64), 0
    for i, inner in enumerate(cuts[1]):
        mine = slab == i
        out[mine] = first + _assign(rows[mine], coordinates, inner, depth + 1)
        first += _leaves(inner)
    return out


def _leaves(cuts) -> int:
    return 1 if cuts is None else sum(_leaves(c) for c in cuts[1])


def _tiled(coordinates: list[int], cuts, further: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(batch.schema.get_field_index("vector")))
            along = rows[:, further] if further < rows.shape[1] else np.zeros(len(rows), np.int64)
            added = [pa.array(_assign(rows, coordinates, cuts)), pa.array(along)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "tile", "along"])

    return run


def _str_order(rows: np.ndarray, leaf_rows: int) -> np.ndarray:
    """Order in which runs of ``leaf_rows`` rows are the leaves of a sort-tile-recursive tree."""
    varying = np.argsort(-rows.astype(np.float64).var(axis=0), kind="stable")[:TILE_COORDINATES] if rows.shape[1] else []

    def order(at: np.ndarray, depth: int) -> np.ndarray:
        if depth == len(varying) or len(at) <= leaf_rows:
            return at
        leaves = math.ceil(len(at) / leaf_rows)
        slabs = math.ceil(leaves ** (1 / (len(varying) - depth)))
        size = math.ceil(leaves / slabs) * leaf_rows
        at = at[np.argsort(rows[at, varying[depth]], kind="stable")]
        return np.concatenate([order(at[i : i + size], depth + 1) for i in range(0, len(at), size)])

    return order(np.arange(len(rows)), 0)


_INDEX = "node bigint, kind string, n int, ids binary, labels binary, vectors binary, low binary, high binary, at binary, floors binary"


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one at a time: packed columns are large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _longs(values: np.ndarray) -> bytes:
    return np.asarray(values, dtype="<i8").tobytes()


def _read(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<i8")


def _subtree(node: int, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, anchor: np.ndarray, k: int, shape: Shape) -> list[dict]:
    """One subtree, and the block of its anchors, each with a score that its kth positive reaches at least."""
    order = _str_order(rows, shape.leaf_rows)
    ids, labels, rows, anchor = ids[order], labels[order], rows[order], anchor[order]
    cuts = np.arange(0, len(rows), shape.leaf_rows)
    low, high = np.minimum.reduceat(rows, cuts, axis=0), np.maximum.reduceat(rows, cuts, axis=0)
    packed = {"low": _pack(low), "high": _pack(high), "at": b"", "floors": b""}
    out = [{"node": node, "kind": "tree", "n": len(rows), "ids": _longs(ids), "labels": _longs(labels), "vectors": _pack(rows), **packed}]
    for first in range(0, int(anchor.sum()), shape.anchors):
        at = np.flatnonzero(anchor)[first : first + shape.anchors]
        scores = products(rows[at], rows)
        scores[labels[at][:, None] != labels[None, :]] = _NO_BOUND
        scores[np.arange(len(at)), at] = _NO_BOUND
        floors = np.sort(scores, axis=1)[:, -k] if len(rows) >= k else np.full(len(at), _NO_BOUND)
        packed = {"low": b"", "high": b"", "at": _longs(at), "floors": _longs(floors)}
        out.append({"node": node, "kind": "anchors", "n": len(at), "ids": _longs(ids[at]), "labels": _longs(labels[at]), "vectors": _pack(rows[at]), **packed})
    return out


def _packed(k: int, shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
        schema = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, _INDEX.split(", "))])
        node = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def closed(rows: pa.Table, node: int) -> pa.RecordBatch:
            column = lambda name: rows[name].combine_chunks()
            parts = (column("id").to_numpy(), column("label").to_numpy(), _matrix(column("vector")), column("anchor").to_numpy(zero_copy_only=False))
            return pa.RecordBatch.from_pylist(_subtree(node, *parts, k, shape), schema)

        for batch in batches:
            held.append(batch)
            while sum(len(b) for b in held) >= shape.subtree_rows:
                rows = pa.Table.from_batches(held)
                yield closed(rows.slice(0, shape.subtree_rows), node)
                node, held = node + 1, rows.slice(shape.subtree_rows).to_batches()
        if rest := [b for b in held if len(b)]:
            yield closed(pa.Table.from_batches(rest), node)

    return run


def build_index(points: DataFrame, k: int, shape: Shape = Shape()) -> DataFrame:
    """The written index of ``points``: one row for each subtree and one for each block of anchors in it.

    The order by tile, one more coordinate and a hash of the row is cut into ranges, so copies of one vector or
    one id, however many, fill several tasks.
    """
    rows, width = points.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    most = min(SAMPLE_ROWS, max(1, SAMPLE_VALUES // max(1, width or 0)))
    some = points.where(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(max(1, rows))) < most).select("vector").limit(most)
    matrix = _matrix(some.toArrow()["vector"].combine_chunks())
    tiles = min(MAX_TILES, math.ceil(rows / shape.subtree_rows))
    coordinates, cuts = _tiles(matrix, tiles) if matrix.size else ([], None)
    rank = np.argsort(-matrix.astype(np.float64).var(axis=0), kind="stable") if matrix.size else [0]
    further = int(rank[min(TILE_COORDINATES, len(rank) - 1)])
    tiled = points.mapInArrow(_tiled(coordinates, cuts, further), "id bigint, label bigint, vector array<bigint>, anchor boolean, tile bigint, along bigint")
    order = ["tile", "along", "salt", "id", "label"]
    parts = max(1, min(MAX_RANGES, math.ceil(rows / shape.subtree_rows)))
    ranged = tiled.withColumn("salt", F.xxhash64("id", "vector")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(ranged.select("id", "label", "vector", "anchor").mapInArrow(_packed(k, shape), _INDEX), "rtree")


# --- search


def _search(queries, labels, tree_rows, tree_ids, tree_labels, low, high, windows, floors, same, own, k, shape):
    """Best first through one subtree for all queries at once.

    ``windows`` is (queries, windows, 2) of scores, ends included, and ``floors`` (queries, windows) what a kth
    answer reaches at least. Gives query, window, score and id of the answers in the subtree, at most ``k`` each.
    """
    n, count = len(queries), windows.shape[1]
    least, greatest = bounds(queries, low, high)
    highest = windows[:, :, 1]
    kth = np.maximum(windows[:, :, 0], floors)
    kth[highest < kth] = np.iinfo(np.int64).max
    score_of = _scorer(queries, tree_rows)
    queue = np.argsort(-greatest, axis=1, kind="stable")
    taken = np.zeros(n, np.int64)
    # Answers so far: number of query and window, score and id, in order of all three.
    best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    while True:
        # The next boxes of a query's queue; a queue ends at the first box below every window's kth.
        open_ = taken < queue.shape[1]
        open_[open_] = greatest[open_, queue[open_, taken[open_]]] >= kth[open_].min(axis=1)
        active = np.flatnonzero(open_)
        if not len(active):
            break
        turn = taken[active][:, None] + np.arange(shape.boxes)
        boxes = queue[active[:, None], np.minimum(turn, queue.shape[1] - 1)]
        # Boxes outside every window, or strictly below every kth, are not opened.
        up, down = greatest[active[:, None], boxes], least[active[:, None], boxes]
        reach = (up[:, :, None] >= kth[active][:, None, :]) & (down[:, :, None] <= highest[active][:, None, :])
        wanted = (turn < queue.shape[1]) & reach.any(axis=2)
        taken[active] += shape.boxes
        opened = np.unique(boxes[wanted])
        if not len(opened):
            continue
        asked = np.zeros((len(active), queue.shape[1]), bool)
        asked[np.nonzero(wanted)[0], boxes[wanted]] = True
        at = (opened[:, None] * shape.leaf_rows + np.arange(shape.leaf_rows)).ravel()
        at = at[at < len(tree_ids)]
        scores = score_of(active, at)
        fits = asked[:, at // shape.leaf_rows] & ((labels[active][:, None] == tree_labels[at]) == same)
        fits &= (scores >= kth[active].min(axis=1)[:, None]) & (scores <= highest[active].max(axis=1)[:, None])
        if own is not None:
            fits &= own[active][:, None] != at
        row, column = np.nonzero(fits)
        score, ids, row = scores[row, column], tree_ids[at[column]], active[row]
        found = []
        for w in range(count):
            mine = (score >= kth[row, w]) & (score <= highest[row, w])
            found.append((row[mine] * count + w, score[mine], ids[mine]))
        best = _first(*[np.concatenate([best[i], *[f[i] for f in found]]) for i in range(3)], k)
        full = np.flatnonzero(np.bincount(best[0], minlength=n * count) == k)
        last = np.searchsorted(best[0], full, side="right") - 1
        kth.reshape(-1)[full] = np.maximum(kth.reshape(-1)[full], best[1][last])
    return best[0] // count, best[0] % count, best[1], best[2]


def _first(of: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` of each query and window by score descending, then id, in that order."""
    order = np.lexsort((ids, -score, of))
    of, score, ids = of[order], score[order], ids[order]
    place = np.arange(len(of)) - np.searchsorted(of, of, side="left")
    return of[place < k], score[place < k], ids[place < k]


def _scorer(queries: np.ndarray, rows: np.ndarray):
    """Function from places of queries and rows to their inner products; doubles are made once if they are exact."""
    a, b = _same_width(queries, rows)
    if a.shape[1] * _largest(a) * _largest(b) >= EXACT:
        return lambda some, at: products(a[some], b[at])
    a, b = a.astype(np.float64), b.astype(np.float64)
    return lambda some, at: (a[some] @ b[at].T).astype(np.int64)


def _reach(windows: np.ndarray, floors: np.ndarray, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> bool:
    """Whether a box can hold an answer of any query; a window that ends before it begins holds none."""
    least, greatest = bounds(queries, low, high)
    lowest, highest = np.maximum(windows[:, :, 0], floors), windows[:, :, 1]
    return bool(((greatest >= lowest) & (least <= highest) & (lowest <= highest)).any())


def _asked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, labels, windows and floors of a block."""
    n = row["n"]
    windows = _read(row["windows"]).reshape(n, -1, 2)
    return _unpack(row["vectors"], n), _read(row["labels"]), windows, _read(row["floors"]).reshape(n, -1)


_BLOCK = "block bigint, n int, ids binary, labels binary, vectors binary, at binary, floors binary, windows binary, part int"
_FOUND = "block bigint, part int, place int, win int, anchor bigint, score bigint, id bigint"


def _answers(same: bool, k: int, shape: Shape):
    """Answers of each group and deal: its blocks come before its subtrees, which have no block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = None, []
        for batch in batches:
            for row in _each(batch):
                if unit != (row["group"], row["deal"]):
                    unit, held = (row["group"], row["deal"]), []
                if row["block"] is not None:
                    held.append(row)
                    continue
                size, leaves = row["n"], shape.leaves(row["n"])
                low, high = _unpack(row["low"], leaves), _unpack(row["high"], leaves)
                root = low.min(axis=0, keepdims=True), high.max(axis=0, keepdims=True)
                tree = (_unpack(row["vectors"], size), _read(row["ids"]), _read(row["labels"]), low, high)
                for block in held:
                    queries, labels, windows, floors = _asked(block)
                    if not _reach(windows, floors, queries, *root):
                        continue
                    own = _read(block["at"]) if row["node"] == block["block"] else None
                    query, window, score, ids = _search(queries, labels, *tree, windows, floors, same, own, k, shape)
                    n = len(query)
                    fixed = [pa.array(np.full(n, block["block"])), pa.array(np.full(n, block["part"], np.int32))]
                    columns = [*fixed, pa.array(query.astype(np.int32)), pa.array(window.astype(np.int32)), pa.array(_read(block["ids"])[query]), pa.array(score), pa.array(ids)]
                    yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _FOUND.split(", ")])

    return run


def search(index: DataFrame, blocks: DataFrame, same: bool, k: int, shape: Shape = Shape()) -> DataFrame:
    """The first ``k`` rows, by score and then id, of every query and window: ``block, part, place, win, rank, score, id``.

    ``blocks`` are rows of anchors with their ``windows`` and ``floors``; ``same`` asks for rows of the anchor's
    label, else for rows of other labels. Each deal of blocks meets each group of subtrees in a task; there, blocks
    meet the roots, and only subtrees whose box can hold an answer of a block are searched for it.
    """
    trees = index.where("kind = 'tree'").select("node", "n", "ids", "labels", "vectors", "low", "high")
    count, anchors = trees.count(), blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    groups = max(1, min(count, max(GROUPS, math.ceil(count / shape.roots))))
    deals = max(1, math.ceil(anchors / shape.held))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # A subtree's number has its range in the upper 32 bits, and its place in the range in the lower ones.
    group = F.pmod(F.shiftright("node", 32) + F.col("node").bitwiseAND(0xFFFFFFFF), F.lit(groups)).cast("int")
    deal = F.pmod(F.xxhash64("block", "part"), F.lit(deals)).cast("int")
    asked = blocks.withColumnRenamed("node", "block").withColumn("deal", deal).withColumn("group", every(groups))
    units = asked.unionByName(trees.withColumn("group", group).withColumn("deal", every(deals)), allowMissingColumns=True)
    order = ["group", "deal", F.col("block").asc_nulls_last(), "node"]
    dealt = units.repartition(groups * deals, "group", "deal").sortWithinPartitions(*order)
    found = dealt.mapInArrow(frugal(_answers(same, k, shape)), _FOUND)
    first = Window.partitionBy("block", "part", "place", "win").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def _first_blocks(index: DataFrame) -> DataFrame:
    """Anchor blocks that ask for the best of all scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", *[f.split()[0] for f in _BLOCK.split(", ")][1:]]
        for batch in batches:
            rows = batch.to_pylist()
            anything = [_longs(np.tile([_NO_BOUND + 1, np.iinfo(np.int64).max], r["n"])) for r in rows]
            parts = [int(_read(r["at"])[0]) for r in rows]
            extra = [pa.array(anything, pa.binary()), pa.array(parts, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names)

    anchors = index.where("kind = 'anchors'").select("node", "n", "ids", "labels", "vectors", "at", "floors")
    return anchors.mapInArrow(run, _BLOCK.replace("block ", "node ", 1))


def _windowed(low: int, high: int, positives: int):
    """Blocks that ask, for each positive, for scores from ``low`` to ``high`` hundredths of its score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", *[f.split()[0] for f in _BLOCK.split(", ")][1:]]
        for batch in batches:
            asked = []
            for row in _each(batch):
                windows = np.tile(np.array([1, 0], np.int64), (row["n"], positives, 1))  # holds nothing
                for p in row["positives"]:
                    windows[p["place"], p["rank"] - 1] = (-(-low * p["score"] // 100), high * p["score"] // 100)
                asked.append((_longs(windows), _longs(np.full((row["n"], positives), _NO_BOUND))))
            found = dict(zip(batch.schema.names, batch.columns))
            found |= {"windows": pa.array([a[0] for a in asked], pa.binary()), "floors": pa.array([a[1] for a in asked], pa.binary())}
            yield pa.RecordBatch.from_arrays([found[name] for name in names], names)

    return run


def mine(points: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, shape: Shape = Shape()) -> DataFrame:
    """Hard negatives of every anchor and positive among ``points`` (as ``vectors`` gives them).

    An anchor's positives are the ``positives`` other rows of its label with the highest scores; for each, its
    negatives are the ``negatives`` best rows of other labels that score from ``low`` to ``high`` hundredths of
    the positive. Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    index = build_index(written(points, "rtree-points"), positives, shape)
    blocks = written(_first_blocks(index), "rtree-blocks")
    best = written(search(index, blocks, True, positives, shape), "rtree-positives")
    by_block = best.groupBy(F.col("block").alias("node"), "part").agg(F.collect_list(F.struct("place", "rank", "score")).alias("positives"))
    second = blocks.join(by_block.hint("merge"), ["node", "part"]).mapInArrow(_windowed(low, high, positives), _BLOCK.replace("block ", "node ", 1))
    found = search(index, written(second, "rtree-windows"), False, negatives, shape)
    named = best.select("block", "part", "place", (F.col("rank") - 1).alias("win"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(named.hint("merge"), ["block", "part", "place", "win"]).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def whole_numbers(components: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, null where it is null or not finite."""
    finite = lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.transform(components.cast("array<double>"), lambda x: F.when(finite(x), F.floor(x * scale)))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row among all rows of ``embeddings``."""
    rows, vec = table(spark, sf_dir, "embeddings"), F.col("vec_id")
    label = F.when(vec % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors(rows, vec, label, whole_numbers(F.col("embedding"), 256), vec % 100 == 0))


OP13_SQL = """
with points as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id, b.label,
         cast(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0) as bigint) as score
  from points a join points b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.positive_id,
       cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as integer) as rank,
       s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and s.label <> s.anchor_label
 and 100 * s.score between 80 * p.positive_score and 100 * p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) <= 5"""
