"""Hard-negative mining over vantage-point trees (operator 13).

A coordinate that fills every vector up to the longest one's norm makes large inner
products of an anchor (whose own extra coordinate is 0) small distances, so that a
window of scores is an annulus around the anchor. A vantage-point tree over a sample
cuts the vectors into cells, and cells into blocks of bounded size; each block has its
own tree, with the range of distances that each node really has. A block is searched
for one anchor and window by an incremental traversal: nodes and rows wait in one
queue, the nearest comes first, nodes outside the annulus never get in, and the
traversal ends as soon as k wanted rows have come out.

Anchors first search the block that they would be in. What they find bounds which other
blocks they need: these get the anchor, in slices of bounded size. The search for
positives and the one for negatives are the same, with other windows and labels.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, small_batches, written
from .topk_search import whole_numbers

LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


@dataclass(frozen=True)
class Settings:
    positives: int = 5
    k: int = 10
    low: int = 30  # a negative's score is at least so many hundredths of the positive's
    high: int = 90  # and at most so many
    leaf: int = 128  # vectors of a node that isn't divided
    block: tuple[int, int] = (4096, 65_536)  # least and most vectors of a block; in between, a 64th of all
    block_bytes: int = 1 << 25  # of a block's vectors as doubles
    cells: int = 1024  # at most
    sample: int = 20_000  # vectors that cells are learned from
    slice: int = 8192  # anchors of a block that are searched by one task
    at_once: int = 256  # anchors whose distances are taken together
    seed: int = 23


@dataclass
class Tree:
    """Nodes in order, parents first. Distances of a node's vectors to its parent's vantage point are within (low, high)."""

    parent: np.ndarray
    low: np.ndarray
    high: np.ndarray
    vantage: np.ndarray  # row of points; -1: a leaf
    kids: np.ndarray
    points: np.ndarray  # vantage points, with their extra coordinate
    limits: np.ndarray  # of each vantage point: vectors up to this distance are inside
    start: np.ndarray
    stop: np.ndarray
    order: np.ndarray  # the tree's vectors, leaf by leaf


def augmented(x: np.ndarray, most: float) -> np.ndarray:
    """Vectors with the coordinate that fills their squared norm up to most."""
    x = x.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(0.0, most - (x * x).sum(1)))[:, None]])


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of each of x to each of y."""
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.sqrt(np.maximum(0.0, d))


def build(x: np.ndarray, leaf: int, depth: int = 64, seed: int = 0, slack: float = 0.0) -> Tree:
    """A vantage-point tree of augmented vectors: halves by the distance to a point, chosen among a few for the widest spread.

    Equal vectors can't be halved and stay one leaf, however many they are. slack widens the nodes' ranges by what rounding may take.
    """
    rng = np.random.default_rng(seed)
    parent, low, high, vantage, kids, points, limits, start, stop = ([] for _ in range(9))
    order = np.arange(len(x))
    todo = [(-1, 0.0, np.inf, 0, len(x), 0)]
    k = 0
    while k < len(todo):
        up, lo, hi, a, b, deep = todo[k]
        for column, value in zip((parent, low, high, vantage, kids, start, stop), (up, lo, hi, -1, (-1, -1), a, b), strict=True):
            column.append(value)
        own = order[a:b]
        if b - a > leaf and deep < depth:
            some = own[rng.integers(0, b - a, 64)]
            spread = distances(x[some], x[some[:4]]).std(0)
            point = x[some[int(spread.argmax())]]
            far = np.sqrt(((x[own] - point) ** 2).sum(1))
            limit = float(np.median(far))
            inside = far <= limit
            if inside.all():
                limit = float(np.nextafter(limit, 0))
                inside = far <= limit
            if inside.any() and not inside.all():
                order[a:b] = np.concatenate([own[inside], own[~inside]])
                middle = a + int(inside.sum())
                vantage[k], kids[k] = len(points), (len(todo), len(todo) + 1)
                points.append(point)
                limits.append(limit)
                todo.append((k, far[inside].min() - slack, far[inside].max() + slack, a, middle, deep + 1))
                todo.append((k, far[~inside].min() - slack, far[~inside].max() + slack, middle, b, deep + 1))
        k += 1
    return Tree(np.array(parent), np.array(low), np.array(high), np.array(vantage), np.array(kids), np.array(points).reshape(len(points), x.shape[1]), np.array(limits), np.array(start), np.array(stop), order)


def open_ranges(t: Tree) -> Tree:
    """The tree for vectors that it wasn't built from: inside and outside of the limits are all that is known."""
    low, high = np.zeros(len(t.low)), np.full(len(t.high), np.inf)
    for k in np.flatnonzero(t.vantage >= 0):
        limit = t.limits[t.vantage[k]]
        high[t.kids[k][0]], low[t.kids[k][1]] = limit, limit
    t.low, t.high = low, high
    return t


def cells_of(t: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf (its node) that each augmented vector belongs to."""
    at = np.zeros(len(x), np.int64)
    for k in np.flatnonzero(t.vantage >= 0):  # parents come first
        own = np.flatnonzero(at == k)
        if len(own):
            far = np.sqrt(((x[own] - t.points[t.vantage[k]]) ** 2).sum(1))
            at[own] = np.where(far <= t.limits[t.vantage[k]], *t.kids[k])
    return at


def score_bounds(t: Tree, q: np.ndarray, most: float, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) score that each of q can have with the vectors of each node; q is augmented with 0."""
    near, far = np.zeros((len(q), len(t.parent))), np.full((len(q), len(t.parent)), np.inf)
    norms = (q * q).sum(1)
    slack = 1e-6 * (np.sqrt(most) + np.sqrt(norms))
    d = distances(q, t.points) if len(t.points) else np.zeros((len(q), 0))
    for k in range(1, len(t.parent)):
        up = t.parent[k]
        own = d[:, t.vantage[up]]
        near[:, k] = np.maximum(near[:, up], np.maximum(own - t.high[k], t.low[k] - own) - slack)
        far[:, k] = np.minimum(far[:, up], own + t.high[k] + slack)
    rounding = 1 + 1e-9 * (most + norms)[:, None]
    top = (norms[:, None] + most - near * near) / 2 + rounding
    top = np.minimum(top, np.sqrt(norms * most)[:, None] + rounding)
    return (norms[:, None] + most - far * far) / 2 - rounding, top


def nearest_first(t: Tree, bottom: np.ndarray, top: np.ndarray, low: int, high: int, scores: Callable[[int], np.ndarray], wanted: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """(score, id) of the wanted vectors with low <= score <= high, best first, equal scores by id.

    bottom, top: score_bounds of the nodes; scores: of a leaf's vectors; wanted, ids: in the tree's order.
    """
    waiting: list[tuple] = []

    def put(k: int) -> None:
        if top[k] >= low and bottom[k] <= high:
            heapq.heappush(waiting, (-min(top[k], high), 0, k, 0, 0))  # before rows with that score

    put(0)
    sorted_runs: list[tuple[np.ndarray, np.ndarray]] = []
    while waiting:
        key, kind, a, run, at = heapq.heappop(waiting)
        if kind:
            yield -key, a
            score, who = sorted_runs[run]
            if at + 1 < len(score):
                heapq.heappush(waiting, (-int(score[at + 1]), 1, int(who[at + 1]), run, at + 1))
        elif t.vantage[a] >= 0:
            for kid in t.kids[a]:
                put(int(kid))
        else:
            span = slice(t.start[a], t.stop[a])
            score = scores(a)
            fit = np.flatnonzero(wanted[span] & (score >= low) & (score <= high))
            if len(fit):
                score, who = score[fit], ids[span][fit]
                first = np.lexsort((who, -score))
                sorted_runs.append((score[first], who[first]))
                heapq.heappush(waiting, (-int(score[first[0]]), 1, int(who[first[0]]), len(sorted_runs) - 1, 0))


class Block:
    """A block's vectors in the order of their tree."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, most: float, s: Settings) -> None:
        self.most, self.dim = most, x.shape[1]
        self.tree = build(augmented(x, most), s.leaf, seed=s.seed, slack=1e-6 * np.sqrt(most))
        order = self.tree.order
        self.x, self.ids, self.labels = x[order], ids[order], labels[order]
        self.largest = max(1, int(np.abs(x).max(initial=0)))
        self.doubles = self.x.astype(np.float64)

    def scores(self, q: np.ndarray) -> Callable[[int], np.ndarray]:
        """Exact scores of a leaf, taken once for each anchor."""
        known: dict[int, np.ndarray] = {}
        exact = max(self.largest, int(np.abs(q).max(initial=0))) ** 2 * self.dim < 2**53
        as_double = q.astype(np.float64)

        def of(leaf: int) -> np.ndarray:
            if leaf not in known:
                span = slice(self.tree.start[leaf], self.tree.stop[leaf])
                known[leaf] = (self.doubles[span] @ as_double).astype(np.int64) if exact else self.x[span] @ q
            return known[leaf]

        return of

    def search(self, q: np.ndarray, ids: np.ndarray, labels: np.ndarray, windows: list[list[tuple[int, int]]], k: int, same: bool) -> Iterator[list[list[tuple[int, int]]]]:
        """For each of q, for each of its windows, the k best (score, id) of the same label and another id, or of other labels."""
        bottom, top = score_bounds(self.tree, augmented(q, 0.0), self.most, self.dim)
        for i in range(len(q)):
            wanted = (self.labels == labels[i]) & (self.ids != ids[i]) if same else self.labels != labels[i]
            of, out = self.scores(q[i]), []
            for low, high in windows[i]:
                found: list[tuple[int, int]] = []
                for row in nearest_first(self.tree, bottom[i], top[i], low, high, of, wanted, self.ids) if low <= high else ():
                    found.append(row)
                    if len(found) == k:
                        break
                out.append(found)
            yield out


def windows_of(scores: list[int] | None, s: Settings) -> list[tuple[int, int]]:
    """The window of each positive's score; one of all scores where there are none to go by."""
    return [(LEAST, MOST)] if scores is None else [(-((-s.low * p) // 100), (s.high * p) // 100) for p in scores]


def packed(x: np.ndarray, kind: str) -> pa.Array:
    """Rows as little-endian whole numbers."""
    return pa.array([r.tobytes() for r in x.astype(np.dtype(kind).newbyteorder("<"))], pa.binary())


def unpacked(column: pa.ChunkedArray | pa.Array, kind: str, dim: int) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.dtype(kind).newbyteorder("<")).astype(np.int64).reshape(len(rows), dim)


CODED = "id long, label long, code binary, cell int"


@dataclass
class Index:
    """The vectors of a table in blocks, and how to search them."""

    s: Settings
    dim: int
    kind: str  # of the packed whole numbers
    most: float  # the largest squared norm
    rows: DataFrame  # CODED, all that takes part
    data: DataFrame  # the same, of very many equal ones only those that can be found
    shared: object  # broadcast (top tree, first block of each cell, blocks of each cell)
    n_blocks: int

    def dealt(self, asks: DataFrame, slices: np.ndarray) -> DataFrame:
        """Blocks with the anchors that search them: data first, a copy for each slice of a block's anchors, and a task for each slice."""
        spark = self.rows.sparkSession
        shared, many = self.shared, spark.sparkContext.broadcast(slices)
        first_task = spark.sparkContext.broadcast((np.cumsum(slices) - slices).astype(np.int32))

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, first, parts = shared.value
            for b in batches:
                block = block_of(b.column("id").to_numpy(), b.column("cell").to_numpy(), first, parts)
                n = many.value[block]
                at = np.repeat(np.arange(len(block)), n)
                nth = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(at)) for c in ("id", "label", "code")] + [pa.array(block[at]), pa.array(nth.astype(np.int32)), pa.array(first_task.value[block[at]] + nth.astype(np.int32))], ["id", "label", "code", "block", "slice", "task"])

        def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                block = b.column("block").to_numpy()
                part = (spread(b.column("id").to_numpy(), 7) % many.value[block].astype(np.uint64)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part), pa.array(first_task.value[block] + part)], [*b.schema.names, "slice", "task"])

        none = F.lit(None).cast("array<long>")
        data = self.data.mapInArrow(placed, "id long, label long, code binary, block int, slice int, task int").select("*", F.lit(False).alias("asks"), none.alias("scores"), none.alias("floors"))
        asks = asks.select("id", "label", "code", "block", "scores", "floors").mapInArrow(sliced, "id long, label long, code binary, block int, scores array<long>, floors array<long>, slice int, task int")
        asks = asks.withColumn("asks", F.lit(True)).select(data.columns)
        return data.unionByName(asks).repartitionById(max(1, int(slices.sum())), "task").drop("task").sortWithinPartitions("block", "slice", "asks", "id")

    def best(self, asks: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        """(query_id, win, vec_id, score, rank): the k best rows in each anchor's windows. asks: CODED and scores; win is a score, or null."""
        s, kind, dim, most, shared = self.s, self.kind, self.dim, self.most, self.shared

        def homed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, first, parts = shared.value
            for b in batches:
                block = block_of(b.column("id").to_numpy(), b.column("cell").to_numpy(), first, parts)
                yield pa.RecordBatch.from_arrays([b.column(c) for c in ("id", "label", "code", "scores")] + [pa.array(block)], ["id", "label", "code", "scores", "block"])

        def searched(batches: Iterator[pa.RecordBatch], first_time: bool) -> Iterator[pa.RecordBatch]:
            top_tree, first, parts = shared.value
            for number, block, t in dealt_blocks(batches, kind, dim, most, s):
                q, ids, labels = unpacked(t.column("code"), kind, dim), t.column("id").to_numpy(), t.column("label").to_numpy()
                scores, floors = t.column("scores").to_pylist(), t.column("floors").to_pylist()
                wins = [windows_of(x, s) for x in scores]
                tight = [[(max(lo, f), hi) for (lo, hi), f in zip(w, fs or [LEAST] * len(w), strict=True)] for w, fs in zip(wins, floors, strict=True)]
                out: list[list] = [[] for _ in range(6)]
                bounds = score_bounds(top_tree, augmented(q, 0.0), most, dim) if first_time else None
                for i, found in enumerate(block.search(q, ids, labels, tight, k, same)):
                    for w, rows in enumerate(found):
                        for score, who in rows:
                            for column, value in zip(out, (ids[i], None if scores[i] is None else scores[i][w], who, score, None, None), strict=True):
                                column.append(value)
                    if first_time:
                        floor = [rows[-1][0] if len(rows) == k else LEAST for rows in found]
                        for to in further(bounds[0][i], bounds[1][i], wins[i], floor, first, parts, number):
                            for column, value in zip(out, (ids[i], None, None, None, to, floor), strict=True):
                                column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k_) for c, k_ in zip(out, KINDS, strict=True)], NAMES)

        made = "query_id long, win long, vec_id long, score long, block int, floors array<long>"
        once = np.ones(self.n_blocks, np.int64)
        own = asks.mapInArrow(homed, "id long, label long, code binary, scores array<long>, block int").withColumn("floors", F.lit(None).cast("array<long>"))
        found = written(self.dealt(own, once).mapInArrow(lambda b: searched(b, True), made), f"{name}-own")
        to = found.where("block is not null").select(F.col("query_id").alias("id"), "block", "floors")
        slices = once.copy()
        for r in to.groupBy("block").agg(F.count("*").alias("n")).collect():  # one row per block
            slices[r.block] = -(-r.n // s.slice)
        rest = self.dealt(to.join(asks.select("id", "label", "code", "scores"), "id"), slices).mapInArrow(lambda b: searched(b, False), made)
        every = found.where("block is null").unionByName(rest).select("query_id", "win", "vec_id", "score")
        order = Window.partitionBy("query_id", "win").orderBy(F.col("score").desc(), "vec_id")
        return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


NAMES = ["query_id", "win", "vec_id", "score", "block", "floors"]
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())]


def spread(ids: np.ndarray, salt: int) -> np.ndarray:
    """Numbers that look random, of ids."""
    h = (ids.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)


def block_of(ids: np.ndarray, cells: np.ndarray, first: np.ndarray, parts: np.ndarray) -> np.ndarray:
    return (first[cells] + (spread(ids, 1) % np.maximum(1, parts[cells]).astype(np.uint64)).astype(np.int64)).astype(np.int32)


def further(bottom: np.ndarray, top: np.ndarray, windows: list[tuple[int, int]], floor: list[int], first: np.ndarray, parts: np.ndarray, own: int) -> Iterator[int]:
    """The blocks, but for its own, that can have a row in one of an anchor's windows that is better than what it has found."""
    need = np.zeros(len(parts), bool)
    for (low, high), f in zip(windows, floor, strict=True):
        if low <= high:
            need |= (top >= max(low, f)) & (bottom <= high)
    for cell in np.flatnonzero(need & (parts > 0)):
        yield from (int(b) for b in range(first[cell], first[cell] + parts[cell]) if b != own)


def dealt_blocks(batches: Iterator[pa.RecordBatch], kind: str, dim: int, most: float, s: Settings) -> Iterator[tuple[int, Block, pa.Table]]:
    """(number, block, some anchors) of a partition sorted by block and slice, vectors first; one block is held at a time."""
    at, held, ready = None, [], None
    for b in batches:
        keys = list(zip(b.column("block").to_pylist(), b.column("slice").to_pylist(), b.column("asks").to_pylist(), strict=True))
        start = 0
        for stop in range(1, len(keys) + 1):
            if stop < len(keys) and keys[stop] == keys[start]:
                continue
            number, nth, asks = keys[start]
            if (number, nth) != at:
                at, held, ready = (number, nth), [], None
            if not asks:
                held.append(b.slice(start, stop - start))
            elif held or ready:
                if ready is None:
                    t = pa.Table.from_batches(held)
                    ready, held = Block(unpacked(t.column("code"), kind, dim), t.column("id").to_numpy(), t.column("label").to_numpy(), most, s), []
                for i in range(start, stop, s.at_once):
                    yield number, ready, pa.Table.from_batches([b.slice(i, min(s.at_once, stop - i))])
            else:  # a block that lost its rows to equal ones elsewhere: nothing is found, but other blocks may be
                none = Block(np.zeros((0, dim), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), most, s)
                for i in range(start, stop, s.at_once):
                    yield number, none, pa.Table.from_batches([b.slice(i, min(s.at_once, stop - i))])
            start = stop


def indexed(vectors: DataFrame, scale: float, s: Settings, id_col: str, vector_col: str, label_col: str) -> Index | None:
    """Blocks of the rows that take part; None if there are none."""
    spark = vectors.sparkSession
    small_batches(spark)
    x = whole_numbers(F.col(vector_col), scale)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), x.alias("v")).where("id is not null and label is not null and v is not null")
    size = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    n, dim, most, large = rows.agg(F.count("*"), F.max(F.size("v")), F.max(size), F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))))).first()
    if not n:
        return None
    dim, large = max(1, dim), large or 0
    kind = "i2" if large < 2**15 else "i4" if large < 2**31 else "i8"
    block = max(1, min(max(s.block[0], n // 64), s.block[1], s.block_bytes // (8 * dim)))
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("v")))
    rows = rows.select("id", "label", padded.alias("v"))

    # The top of the tree comes from a bounded sample, every vector gets its cell.
    share = int(min(1.0, s.sample / n) * 1_000_000)
    some = rows.where(F.pmod(F.xxhash64("id", F.lit(s.seed)), F.lit(1_000_000)) < share).limit(2 * s.sample).select("v").toArrow().column("v")
    flat = np.array(some.to_pylist(), np.int64).reshape(len(some), dim)
    depth = int(np.ceil(np.log2(max(1, min(s.cells, -(-n // block))))))
    top = open_ranges(build(augmented(flat, most), 1, depth, s.seed))
    top.order = np.zeros(0, np.int64)
    tree = spark.sparkContext.broadcast(top)

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim)
            cell = cells_of(tree.value, augmented(v, most)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), packed(v, kind), pa.array(cell)], ["id", "label", "code", "cell"])

    coded = written(rows.mapInArrow(celled, CODED), "negatives-rows")
    # Of equal vectors with one label only the smallest ids can be among the k best, and only as many rows of each.
    most_wanted = max(s.positives, s.k)
    crowd = coded.groupBy(F.xxhash64("code", "label").alias("key")).agg(F.count("*").alias("n")).where(F.col("n") > 16 * most_wanted).select("key")
    crowd = bounded(written(crowd, "negatives-crowded"), 500_000)
    keyed = coded.withColumn("key", F.xxhash64("code", "label"))
    again, equal = Window.partitionBy("code", "label", "id").orderBy("cell"), Window.partitionBy("code", "label").orderBy("id")
    few = keyed.join(crowd, "key", "left_semi").withColumn("nth", F.row_number().over(again)).where(F.col("nth") <= most_wanted)
    few = few.withColumn("nth", F.dense_rank().over(equal)).where(F.col("nth") <= most_wanted + 1).drop("nth")
    data = written(keyed.join(crowd, "key", "left_anti").unionByName(few).drop("key"), "negatives-data")
    parts = np.zeros(len(top.parent), np.int64)
    for r in data.groupBy("cell").agg(F.count("*").alias("n")).collect():  # one row per cell
        parts[r.cell] = -(-r.n // block)
    parts = np.maximum(parts, top.vantage < 0)  # an empty cell can still be some anchor's home
    shared = spark.sparkContext.broadcast((top, np.cumsum(parts) - parts, parts))
    return Index(s, dim, kind, most, coded, data, shared, int(parts.sum()))


def mine(vectors: DataFrame, every: int, scale: float = 256.0, s: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:  # noqa: B008
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows whose id is divisible by every.

    An anchor's positives are the s.positives best other rows of its label; a positive's negatives are the s.k best rows of other
    labels whose score is between s.low and s.high hundredths of the positive's. Scores are inner products of components times scale,
    rounded down, and must fit 64 bits; higher ones come first, ties by smaller id. Rows without id or label, and vectors that are null or
    hold null or non-finite components, take no part; shorter vectors count as filled up with zeros. Repeated rows can each be found; an
    anchor that occurs more than once is answered once, by its least label and vector, and none of its rows is its positive. Other columns aren't
    looked at; an empty table gives no rows.
    """
    index = indexed(vectors, scale, s, id_col, vector_col, label_col)
    if index is None:
        long = F.lit(0).cast("long")
        return vectors.sparkSession.range(0).select(*(long.alias(c) for c in ("anchor_id", "positive_id")), F.lit(0).alias("rank"), *(long.alias(c) for c in ("negative_id", "positive_score", "negative_score")))
    anchors = index.rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "code", "cell")).alias("r")).select("id", "r.*")
    anchors = written(anchors, "negatives-anchors")
    positives = index.best(anchors.withColumn("scores", F.lit(None).cast("array<long>")), s.positives, True, "negatives-positives")
    positives = written(positives.select(F.col("query_id").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-pairs")
    scores = positives.groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_set("positive_score")).alias("scores"))  # s.positives at most
    found = index.best(anchors.join(scores, "id"), s.k, False, "negatives-found")
    found = found.select(F.col("query_id").alias("anchor_id"), F.col("win").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return positives.join(found, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
