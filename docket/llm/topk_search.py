"""Exact top-k inner products by dual cover trees (operator 10).

The top level of the data's tree is a set of centres, with the vectors nearest to each
as its cells; a cell is one block, or several if it is large. Every query searches its
own cell's block first, which gives it a k-th score. A tree over a block's queries then
meets the table of all blocks: a block whose largest possible product with a group
of queries, by centres and covering radii, is below the group's worst k-th score is
left out for the group, and so for single queries. Only the blocks that are left see
the query. Within a block the trees of queries and data are searched together in the
same way. A last step merges the results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, matrix, written

LEAST = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Settings:
    k: int = 5
    leaf: int = 48  # points below which a node isn't divided
    crumbs: int = 8  # children smaller than this share one leaf
    levels: int = 12  # halvings of a node's radius that are tried for a level on which points hold together
    data_block: tuple[int, int] = (1024, 65_536)  # least and most; in between, a 64th of the rows
    query_block: int = 2048  # queries that are searched together
    centres: int = 1024  # cells at most
    sample: int = 20_000  # vectors that centres are learned from


@dataclass
class Node:
    """Points within radius of centre; a leaf has no children."""

    points: np.ndarray
    centre: np.ndarray
    radius: float
    norm: float
    children: list[Node] = field(default_factory=list)


def build(x: np.ndarray, s: Settings) -> Node:
    """A cover tree, level by level: centres of a level are farther apart than its scale, which halves.

    A child holds the points that its centre covers first. Children of very few points
    are pooled, or scattered points would make a node each.
    """

    def node(points: np.ndarray, centre: np.ndarray) -> Node:
        far = np.sqrt(((x[points] - centre) ** 2).sum(1))
        return Node(points, centre, float(far.max(initial=0)), float(np.sqrt(centre @ centre)))

    def divide(n: Node, scale: float) -> None:
        if len(n.points) <= s.leaf or n.radius == 0:
            return
        scale = min(scale, n.radius)
        for _ in range(s.levels):  # nothing holds together on a level, or all does: try the next
            scale /= 2
            rest, crumbs, parts = n.points, [], []
            while len(rest) and len(parts) + len(crumbs) * s.crumbs <= len(n.points):
                far = np.sqrt(((x[rest] - x[rest[0]]) ** 2).sum(1))
                inside = far <= scale
                (parts if inside.sum() >= s.crumbs else crumbs).append(rest[inside])
                rest = rest[~inside]
                if not parts and len(crumbs) >= 4 * s.crumbs:
                    break
            if parts and len(parts[0]) < len(n.points):
                break
        else:
            return
        for p in parts:
            child = node(p, x[p].mean(0))
            divide(child, scale)
            n.children.append(child)
        if crumbs or len(rest):
            n.children.append(node(np.sort(np.concatenate([*crumbs, rest])), n.centre))

    top = node(np.arange(len(x)), x.mean(0))
    divide(top, 2 * top.radius)
    return top


def upper(x: np.ndarray, norms: np.ndarray, centre: np.ndarray, radius: float, slack: float) -> np.ndarray:
    """The largest product that each of x can have within radius of centre."""
    return x @ centre + norms * radius + slack


def slack_of(*blocks: np.ndarray) -> float:
    """What rounding may take from a bound."""
    top = max(1, *(int(np.abs(b).max(initial=0)) for b in blocks))
    return 1 + 1e-9 * float(top) * float(top) * blocks[0].shape[1]


def search(q: np.ndarray, q_ids: np.ndarray, d: np.ndarray, d_ids: np.ndarray, s: Settings, floor: np.ndarray | None = None, tree: Node | None = None, seen: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of each query's k best rows of d, LEAST where there are fewer; d_ids ascend.

    Rows with the query's own id are left out. Equal scores go to the smaller id. Scores
    below a query's floor aren't looked for. tree: d's, if it has been built already;
    seen gets the number of pairs of each leaf that were evaluated.
    """
    best = np.full((len(q), s.k), LEAST, np.int64)
    names = np.zeros((len(q), s.k), np.int64)
    if not len(q) or not len(d):
        return best, names
    dim = q.shape[1]
    top = max(1, int(np.abs(q).max(initial=0)), int(np.abs(d).max(initial=0)))
    exact = top * top * dim < 2**53  # doubles hold every product and sum
    qx, dx = (q.astype(np.float64), d.astype(np.float64))
    slack = slack_of(q, d)
    norms = np.sqrt((qx * qx).sum(1))
    limit = np.full(len(q), LEAST, np.int64) if floor is None else floor.copy()

    def bound(a: Node, b: Node) -> float:
        return float(a.centre @ b.centre) + a.norm * b.radius + a.radius * b.norm + a.radius * b.radius + slack

    def leaf(a: Node, b: Node) -> None:
        rows = a.points[upper(qx[a.points], norms[a.points], b.centre, b.radius, slack) >= limit[a.points]]
        if not len(rows):
            return
        if seen is not None:
            seen.append(len(rows) * len(b.points))
        score = (qx[rows] @ dx[b.points].T).astype(np.int64) if exact else q[rows] @ d[b.points].T
        score[q_ids[rows][:, None] == d_ids[b.points][None, :]] = LEAST
        worth = score.max(1) >= limit[rows]
        rows, score = rows[worth], score[worth]
        if not len(rows):
            return
        first = np.argsort(-score.astype(np.float64) if exact else _descending(score), 1, kind="stable")[:, : s.k]
        both = np.hstack([best[rows], np.take_along_axis(score, first, 1)])
        who = np.hstack([names[rows], d_ids[b.points][first]])
        order = np.lexsort((who, _descending(both)), axis=1)[:, : s.k]
        best[rows], names[rows] = np.take_along_axis(both, order, 1), np.take_along_axis(who, order, 1)
        limit[rows] = np.maximum(limit[rows], best[rows, -1])

    def visit(a: Node, b: Node) -> None:
        if bound(a, b) < limit[a.points].min():
            return
        if not a.children and not b.children:
            leaf(a, b)
        elif not a.children or (b.children and b.radius >= a.radius):
            for c in sorted(b.children, key=lambda c: -bound(a, c)):
                visit(a, c)
        else:
            for c in a.children:
                visit(c, b)

    visit(build(qx, replace(s, leaf=min(s.leaf, 16), crumbs=2)), tree or build(dx, s))
    return best, names


def blocks_to_visit(q: np.ndarray, limit: np.ndarray, centres: np.ndarray, radii: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(rows of q, blocks) that meet: groups of queries are held against each block first, then single ones."""
    x = q.astype(np.float64)
    norms, sizes = np.sqrt((x * x).sum(1)), np.sqrt((centres * centres).sum(1))
    slack = slack_of(q, centres)
    out_q, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def visit(a: Node, blocks: np.ndarray) -> None:
        most = centres[blocks] @ a.centre + a.norm * radii[blocks] + a.radius * (sizes[blocks] + radii[blocks]) + slack
        blocks = blocks[most >= limit[a.points].min()]
        for c in a.children if len(blocks) else ():
            visit(c, blocks)
        if len(blocks) and not a.children:
            able = x[a.points] @ centres[blocks].T + norms[a.points][:, None] * radii[blocks][None, :] + slack >= limit[a.points][:, None]
            i, j = np.nonzero(able)
            out_q.append(a.points[i])
            out_b.append(blocks[j])

    if len(q):
        visit(build(x, replace(s, leaf=16, crumbs=2)), np.arange(len(centres)))
    return np.concatenate(out_q), np.concatenate(out_b)


def learned_centres(x: np.ndarray, n: int, seed: int = 3, rounds: int = 8) -> np.ndarray:
    """At most n centres of x, by Lloyd's rounds from points far from each other."""
    x = x.astype(np.float64)
    rng = np.random.default_rng(seed)
    if not len(x):
        return np.zeros((1, x.shape[1]))
    chosen = [int(rng.integers(len(x)))]
    far = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(rng.choice(len(x), p=far / far.sum())))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
    centres = x[chosen]
    for _ in range(rounds):
        at = nearest(x, centres)[0]
        for c in range(len(centres)):
            if (own := at == c).any():
                centres[c] = x[own].mean(0)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the centre that each of x is nearest to, its distance)."""
    at = np.concatenate([np.argmin((centres * centres).sum(1) - 2 * (x[i : i + 4096] @ centres.T), 1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])
    return at, np.sqrt(((x - centres[at]) ** 2).sum(1))


def _descending(score: np.ndarray) -> np.ndarray:
    """Keys that sort scores downwards; LEAST goes last (its negation would overflow)."""
    return np.where(score == LEAST, np.iinfo(np.int64).max, -np.where(score == LEAST, 0, score))


def whole_numbers(vector: Column, scale: float) -> Column:
    """Components times scale, rounded down; null for vectors that take no part."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda c: F.floor(F.lit(scale) * c.cast("double"))))


def top_k(vectors: DataFrame, every: int, scale: float = 256.0, s: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:  # noqa: B008
    """(query_id, rank, vec_id, score): the k best rows for each row whose id is divisible by every.

    Candidates are all rows but those with the query's id. Vectors that are null or hold
    null or non-finite components, and rows without id, take no part; shorter vectors
    count as filled up with zeros. A query that occurs twice is answered twice as
    one (its rows appear once). Scores must fit 64 bits. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), whole_numbers(F.col(vector_col), scale).alias("v")).where("id is not null and v is not null")
    rows = written(rows, "topk-vectors")
    n, dim = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    dim = max(1, dim or 1)
    size = min(s.data_block[1], max(s.data_block[0], n // 64))
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("v")))
    rows = rows.select("id", padded.alias("v"))

    # Centres from a bounded sample; every vector goes to the nearest.
    share = min(1.0, s.sample / max(1, n))
    some = rows.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000)) < int(share * 1_000_000)).limit(2 * s.sample).select("v").toArrow().column("v")
    centres = learned_centres(matrix(some) if len(some) else np.zeros((0, dim), np.int64), min(s.centres, -(-n // size)))
    top_level = spark.sparkContext.broadcast(centres)

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(pa.chunked_array([b.column("v")])).astype(np.float64) if b.num_rows else np.zeros((0, dim))
            at, far = nearest(x, top_level.value)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(at.astype(np.int32)), pa.array(far)], ["id", "v", "cell", "far"])

    kinds = "id long, v array<long>, cell int, far double"
    cells = written(rows.mapInArrow(celled, kinds).withColumn("key", F.xxhash64("v")), "topk-cells")
    # Of equal vectors only k rows of each of the k + 1 smallest ids can be among a query's k best.
    crowd = written(cells.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 16 * s.k).select("key"), "topk-crowded")
    crowd = bounded(crowd, 500_000)
    again, equal = Window.partitionBy("key", "v", "id").orderBy("far"), Window.partitionBy("key", "v").orderBy("id")
    few = cells.join(crowd, "key", "left_semi").withColumn("nth", F.row_number().over(again)).where(F.col("nth") <= s.k)
    few = few.withColumn("nth", F.dense_rank().over(equal)).where(F.col("nth") <= s.k + 1).drop("nth")
    kept = written(cells.join(crowd, "key", "left_anti").unionByName(few), "topk-kept")
    stats = kept.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).orderBy("cell").collect()  # one row per cell
    parts = {r.cell: -(-r.n // size) for r in stats}
    table = [(r.cell, p, r.radius) for r in stats for p in range(parts[r.cell])]  # about a block per size rows
    places = {(c, p): i for i, (c, p, _) in enumerate(table)}
    at_most = max([1, *parts.values()])
    blocks_of = np.full((len(centres), at_most), -1, np.int32)
    for (c, p), i in places.items():
        blocks_of[c, p] = i
    counts = np.array([parts.get(c, 0) for c in range(len(centres))], np.int64)
    radii = np.array([r for *_, r in table])
    shared = spark.sparkContext.broadcast((np.array([centres[c] for c, _, _ in table]).reshape(len(table), dim), radii, blocks_of, counts))

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, n_parts = shared.value[2:]
        for b in batches:
            cell, ids = b.column("cell").to_numpy(), b.column("id").to_numpy()
            part = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.maximum(1, n_parts[cell]).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(of[cell, part.astype(np.int64)])], ["id", "v", "block"])

    none = F.lit(None).cast("long")
    asks = cells.where(F.col("id") % every == 0).dropDuplicates(["id"])
    data = kept.mapInArrow(blocked, "id long, v array<long>, block int").select("id", "v", "block", F.lit(False).alias("asks"), none.alias("floor"))
    own = asks.mapInArrow(blocked, "id long, v array<long>, block int").select("id", "v", "block", F.lit(True).alias("asks"), none.alias("floor"))
    dealt = lambda queries: data.unionByName(queries).repartition("block").sortWithinPartitions("block", "asks", "id")

    def searched(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
        for block, t, d, d_ids, tree in _chunks(batches, s):
            q, ids = matrix(t.column("v")), t.column("id").to_numpy()
            floor = None if first else t.column("floor").to_numpy()
            score, who = search(q, ids, d, d_ids, s, floor, tree)
            i, j = np.nonzero(score > LEAST)
            yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(who[i, j]), pa.array(score[i, j]), pa.nulls(len(i), pa.list_(pa.int64())), pa.nulls(len(i), pa.int32())], NAMES)
            if first:
                middles, reach = shared.value[:2]
                rows_, to = blocks_to_visit(q, score[:, -1], middles, reach, s)
                rows_, to = rows_[to != block], to[to != block]
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows_]), pa.nulls(len(to), pa.int64()), pa.array(score[rows_, -1]), t.column("v").combine_chunks().take(pa.array(rows_)), pa.array(to.astype(np.int32))], NAMES)

    kinds = "query_id long, vec_id long, score long, v array<long>, block int"
    found = written(dealt(own).mapInArrow(lambda b: searched(b, True), kinds), "topk-first")
    further = found.where("block is not null").select(F.col("query_id").alias("id"), "v", "block", F.lit(True).alias("asks"), F.col("score").alias("floor"))
    rest = dealt(further).mapInArrow(lambda b: searched(b, False), kinds)
    found = found.where("block is null").unionByName(rest).select("query_id", "vec_id", "score")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.k).select("query_id", "rank", "vec_id", "score")


NAMES = ["query_id", "vec_id", "score", "v", "block"]


def _chunks(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[tuple[int, pa.Table, np.ndarray, np.ndarray, Node]]:
    """(block, some of its queries, its vectors, their ids, their tree) of a partition sorted by block, vectors first.

    A block's vectors are held, bounded by the block's size; its queries pass by, s.query_block at a time.
    """
    block, held, waiting, ready = None, [], [], None

    def some() -> Iterator[tuple]:
        nonlocal ready, waiting
        if waiting and ready is None and held:
            t = pa.Table.from_batches(held)
            d = matrix(t.column("v"))
            ready = (d, t.column("id").to_numpy(), build(d.astype(np.float64), s))
            held.clear()
        if waiting and ready is not None:
            yield (block, pa.Table.from_batches(waiting), *ready)
        waiting = []

    for b in batches:
        of, asks = b.column("block").to_numpy(), b.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        edges = np.flatnonzero((np.diff(of) != 0) | (np.diff(asks.astype(int)) != 0)) + 1
        for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows], strict=True):
            if start == stop:
                continue
            if of[start] != block:
                yield from some()
                block, held, ready = int(of[start]), [], None
            if not asks[start]:
                held.append(b.slice(start, stop - start))
                continue
            for i in range(start, stop, s.query_block):
                waiting.append(b.slice(i, min(s.query_block, stop - i)))
                if sum(w.num_rows for w in waiting) >= s.query_block:
                    yield from some()
    yield from some()
