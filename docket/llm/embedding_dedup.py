"""Near duplicates among embeddings by iterative quantisation (operator 8).

A rotation is learned on a sample so that the signs of the rotated vectors are
balanced binary codes that lose little. The codes are cut into substrings, one hash
table for each (multi-index Hamming search); vectors that share a substring are
compared by the cosine of their original vectors in double precision. The number
of tables follows from the substrings' length and the recall that is wanted, as
measured with the codes themselves on partners made for the sample's vectors: codes
are cut through the mean, where the angle between near vectors may be far larger
than at the origin.

Equal vectors are one class from the start. Within a table, a bucket is compared by
matrix products in blocks of bounded size; what leaves it is a count per vector and
a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, components, matrix, runs, written


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.98
    recall: float = 0.975  # wanted for pairs at the threshold itself, by the model of random planes
    sample: int = 4000  # vectors that rotations are learned from
    rounds: int = 30
    block: int = 2048  # vectors of a bucket compared at a time
    most: int = 48  # tables beyond which substrings are made shorter instead
    seed: int = 17


def rotation(x: np.ndarray, s: Settings, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): principal directions, turned until signs lose least (alternating with Procrustes)."""
    rng = np.random.default_rng(seed)
    dim = x.shape[1]
    mean = x.mean(0) if len(x) else np.zeros(dim)
    spread = np.linalg.svd(x - mean, full_matrices=True)[2].T if len(x) > 1 else np.eye(dim)
    y = (x - mean) @ spread
    turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    for _ in range(s.rounds if len(x) > dim else 0):
        u, _, v = np.linalg.svd(np.where(y @ turn >= 0, 1.0, -1.0).T @ y)
        turn = (u @ v).T
    return mean, spread @ turn


def tables_for(bits: int, s: Settings) -> int:
    """Tables of so many bits that together find a pair at the threshold with the wanted chance."""
    same = (1 - math.acos(min(1.0, s.threshold)) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - s.recall) / math.log(1 - same)))


@dataclass(frozen=True)
class Quantiser:
    bits: int
    tables: int
    means: np.ndarray  # rotations x dim
    planes: np.ndarray  # rotations x dim x dim

    def codes(self, x: np.ndarray) -> np.ndarray:
        """A substring of the code for each table."""
        signs = np.hstack([(x - m) @ p >= 0 for m, p in zip(self.means, self.planes, strict=True)])[:, : self.bits * self.tables]
        return (signs.reshape(len(x), self.tables, self.bits) @ (1 << np.arange(self.bits))).astype(np.int32)


def partners(x: np.ndarray, s: Settings) -> list[np.ndarray]:
    """Unit vectors at the threshold from each of x: in any direction, and in directions in which x's vectors differ."""
    rng = np.random.default_rng(s.seed)
    out = []
    for to in (rng.normal(size=x.shape), x[rng.permutation(len(x))] - x):
        to = to - (to * x).sum(1, keepdims=True) * x
        size = np.sqrt((to * to).sum(1, keepdims=True))
        to = np.divide(to, size, out=np.zeros_like(to), where=size > 1e-9)
        out.append(s.threshold * x + math.sqrt(max(0.0, 1 - s.threshold**2)) * to)
    return out


def tables_needed(q: Quantiser, x: np.ndarray, labels: list, s: Settings) -> int | None:
    """The first tables of q that bring the wanted share of made pairs together, for each label with enough of them; None: all are too few."""
    own, need = q.codes(x), 1
    kinds, of = np.unique([str(k) for k in labels], return_inverse=True)
    groups = [np.full(len(x), True), *(of == k for k in np.flatnonzero(np.bincount(of, minlength=len(kinds)) >= 50))]
    for y in partners(x, s):
        same = own == q.codes(y)
        first = np.where(same.any(1), same.argmax(1), q.tables)
        for mine in (first[g] for g in groups):
            need = max(need, int(np.sort(mine)[math.ceil(s.recall * len(mine)) - 1]) + 1)
    return need if need <= q.tables else None


def fit(x: np.ndarray, largest: int, s: Settings, labels: list | None = None) -> Quantiser:
    """largest: vectors of the largest label; substrings are long enough that few unlike vectors share one, and short enough for the wanted recall."""
    groups = [None] * len(x) if labels is None else labels
    top = min(30, max(10, math.ceil(math.log2(max(2, largest))) + 2))
    turns: list[tuple[np.ndarray, np.ndarray]] = []

    def cut(bits: int, tables: int) -> Quantiser:
        used = -(-bits * tables // x.shape[1])
        turns.extend(rotation(x, s, s.seed + k) for k in range(len(turns), used))
        return Quantiser(bits, tables, np.stack([m for m, _ in turns[:used]]), np.stack([p for _, p in turns[:used]]))

    for bits in range(top, 0, -1):
        least = tables_for(bits, s)
        for most in (2 * least, max(least, s.most)):
            if tables := tables_needed(cut(bits, most), x, groups, s):
                return cut(bits, max(tables, least))
    return cut(1, max(s.most, tables_for(1, s)))


def links_within(x: np.ndarray, codes: np.ndarray, mult: np.ndarray, table: int, sides: np.ndarray | None, s: Settings) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(links of each vector to others, spanning forest) of one group; sides: only pairs across.

    A pair that an earlier table has brought together already is left to that table.
    """
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    near = unit @ unit.T >= s.threshold
    np.fill_diagonal(near, False)
    for t in range(table):
        near &= codes[:, t][:, None] != codes[:, t][None, :]
    if sides is not None:
        near &= sides[:, None] != sides[None, :]
    links = near @ mult
    parent = list(range(len(x)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    forest = []
    for i in np.flatnonzero(links):
        for j in np.flatnonzero(near[i, :i]):
            a, b = root(i), root(int(j))
            if a != b:
                parent[a] = b
                forest.append((int(i), int(j)))
    return links, forest


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, all components there and finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda c: c != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, s: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:  # noqa: B008
    """(id, n_links, component_id, kept) for every row.

    Only vectors of equal labels link. A null label, or a vector that is null, empty,
    zero or has null or non-finite components, links with nothing and is kept. Shorter
    vectors count as filled up with zeros. Repeated rows are vectors of their own (with
    the same id). An empty table gives no rows; other columns are not read.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    label = vectors.schema[label_col].dataType.simpleString()
    raw = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    ok = F.col("label").isNotNull() & F.col("id").isNotNull() & usable(F.col("v"))
    # a digest of the components' text stands for the vector; equal ones are one class
    members = written(raw.select("id", "label", F.when(ok, F.sha2(F.col("v").cast("string"), 256)).alias("key")), "vec-members")
    classes = raw.where(ok).groupBy("label", F.sha2(F.col("v").cast("string"), 256).alias("key")).agg(F.min("id").alias("rep"), F.count("*").alias("mult"), F.first("v").alias("v"))
    classes = written(classes, "vec-classes")
    top = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first().n
    if top is None:
        return members.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    dim = classes.agg(F.max(F.size("v"))).first()[0]
    sample = classes.select("key", "v", "label").orderBy("key").limit(s.sample).collect()

    def filled(column: pa.Array | list) -> np.ndarray:
        rows = column if isinstance(column, list) else column.to_pylist()
        x = np.array([r + [0.0] * (dim - len(r)) for r in rows], np.float64).reshape(len(rows), dim)
        return x / np.abs(x).max(1, initial=1e-300)[:, None]  # so that squares stay finite

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.sqrt((x * x).sum(1))[:, None]

    quantiser = fit(unit(filled([r.v for r in sample])), top, s, [r.label for r in sample])
    shared = vectors.sparkSession.sparkContext.broadcast(quantiser)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                codes = shared.value.codes(unit(filled(b.column("v"))))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(codes.tolist(), pa.list_(pa.int32()))], ["rep", "label", "mult", "v", "codes"])

    index = written(classes.select("rep", "label", "mult", "v").mapInArrow(encode, f"rep {kind}, label {label}, mult long, v array<double>, codes array<int>"), "vec-index")

    # buckets of two or more, and the blocks that a large one is cut into
    entry = index.select("rep", "label", F.posexplode("codes").alias("t", "code"))
    full = entry.groupBy("label", "t", "code").agg(F.count("*").alias("n")).where("n > 1")
    full = written(full.withColumn("cuts", F.ceil(F.col("n") / s.block).cast("int")), "vec-buckets")
    entry = entry.join(bounded(full.select("label", "t", "code", "cuts"), 500_000), ["label", "t", "code"])
    own = F.pmod(F.xxhash64(F.lit(s.seed), "rep"), "cuts").cast("int")
    entry = entry.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    entry = entry.select(F.col("rep").alias("r"), "t", F.xxhash64("label", "t", "code").alias("g"), "code", F.col("label").alias("l"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")
    rows = entry.join(index, (F.col("l") == F.col("label")) & (F.col("r") == F.col("rep"))).drop("r", "label")
    group = ["g", "l", "t", "code", "i", "j"]
    dealt = rows.repartition(*group).sortWithinPartitions(*group, "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, table, _, i, j), rows in runs(batches, group):
            reps = rows.column("rep").combine_chunks()
            sides = rows.column("own").to_numpy() if i != j else None
            links, forest = links_within(filled(rows.column("v").to_pylist()), matrix(rows.column("codes")), rows.column("mult").to_numpy(), table, sides, s)
            some = np.flatnonzero(links)
            a = pa.array([*some, *(x for x, _ in forest)], pa.int64())
            b = pa.array([*some, *(y for _, y in forest)], pa.int64())
            n = pa.array([*links[some].tolist(), *(0 for _ in forest)], pa.int64())
            yield pa.RecordBatch.from_arrays([reps.take(a), reps.take(b), n], ["a", "b", "links"])

    found = written(dealt.mapInArrow(compare, f"a {kind}, b {kind}, links long"), "vec-links")
    count = found.where("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.where("a <> b").select("a", "b"), "vec-cc")
    known = classes.select("label", "key", "rep", "mult").join(count, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    known = written(known.select("label", "key", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root")), "vec-known")
    out = members.join(bounded(known, 100_000), ["label", "key"], "left")
    out = out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
