"""Operators 8 and 10 against brute force."""

import math

import numpy as np
import pytest

from docket.llm import embedding_dedup as dedup
from docket.llm import topk_search as topk

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, rank int"


def clustered(n, seed, dim=16):
    """Loose points, tight groups of near copies, and exact copies."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 20 + 1, dim))
    x = rng.normal(size=(n, dim))
    near = rng.random(n) < 0.6
    x[near] = centres[rng.integers(0, len(centres), near.sum())] + rng.normal(size=(near.sum(), dim)) * 0.08
    copy = rng.random(n) < 0.2
    x[copy] = x[rng.integers(0, n, copy.sum())]
    return x.astype(np.float32), rng.integers(0, 3, n)


def frame(spark, x, labels):
    return spark.createDataFrame([(i, v.tolist(), int(y), "x", 0) for i, (v, y) in enumerate(zip(x, labels, strict=True))], SCHEMA).repartition(3)


def brute_links(x, labels, threshold=0.98):
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    near = (u @ u.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    comp = np.arange(len(x))
    while True:
        low = np.array([min(c, *comp[near[i]]) if near[i].any() else c for i, c in enumerate(comp)])
        if (low == comp).all():
            return near, comp
        comp = low


@pytest.mark.parametrize("block", [2048, 16])
def test_links(spark, block):
    x, labels = clustered(600, 1)
    near, comp = brute_links(x, labels)
    got = {r.vec_id: r for r in dedup.near_duplicates(frame(spark, x, labels), dedup.Settings(block=block)).collect()}
    assert len(got) == 600
    links = np.array([got[i].n_links for i in range(600)])
    assert (links <= near.sum(1)).all()
    assert links.sum() >= 0.97 * near.sum()
    assert np.mean([got[i].component_id == comp[i] for i in range(600)]) > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


@pytest.mark.parametrize("share", [0.0, 0.9, 0.95])
def test_links_with_a_common_mean(spark, share):
    """Vectors of one direction and a small own part: pairs near the threshold are far from each other as seen from the mean."""
    rng = np.random.default_rng(6)
    unit = lambda a: a / np.linalg.norm(a, axis=1)[:, None]
    x = np.sqrt(1 - share) * unit(rng.normal(size=(1600, 64)))
    x[:, 0] = np.sqrt(share)
    x = unit(x)
    c = rng.uniform(0.9805, 0.99, 800)[:, None]
    off = rng.normal(size=(800, 64))
    off = unit(off - (off * x[:800]).sum(1, keepdims=True) * x[:800])
    x[800:] = c * x[:800] + np.sqrt(1 - c * c) * off
    labels = np.zeros(1600, int)
    near, comp = brute_links(x.astype(np.float32), labels)
    got = {r.vec_id: r for r in dedup.near_duplicates(frame(spark, x.astype(np.float32), labels)).collect()}
    assert sum(got[i].n_links for i in range(1600)) >= 0.95 * near.sum() > 1500
    assert np.mean([got[i].component_id == comp[i] for i in range(1600)]) > 0.95


def test_odd_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [1.0, None], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [], 1), (11, [1.0, 0.0], 1), (11, [1.0, 0.0], 1), (12, [1.0], 1)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in dedup.near_duplicates(df).collect()}
    alone = {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)}
    assert got == alone | {(1, 4, 1, True), (2, 4, 1, False), (11, 4, 1, False), (12, 4, 1, False)}
    assert dedup.near_duplicates(df).count() == 13
    assert dedup.near_duplicates(df.limit(0)).count() == 0
    assert {r.n_links for r in dedup.near_duplicates(df.where("vec_id = 5")).collect()} == {0}


def brute_top(x, ids, every, k):
    v = np.floor(256.0 * x.astype(float)).astype(np.int64)
    out = []
    for i in np.flatnonzero(ids % every == 0):
        other = ids != ids[i]
        best = sorted(zip((-(v[other] @ v[i])).tolist(), ids[other].tolist(), strict=True))[:k]
        out += [(int(ids[i]), r + 1, b, -a) for r, (a, b) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("s", [topk.Settings(), topk.Settings(k=3, leaf=4, crumbs=2, data_block=(64, 100), query_block=7, sample=200)])
def test_top(spark, s):
    x, labels = clustered(700, 2)
    got = sorted(tuple(r) for r in topk.top_k(frame(spark, x, labels), 10, s=s).collect())
    assert got == brute_top(x, np.arange(700), 10, s.k)


def test_trees_hold_their_points():
    x, _ = clustered(2000, 3)
    x = np.floor(x * 256).astype(np.int64)
    tree = topk.build(x.astype(float), topk.Settings())

    def check(n):
        far = np.sqrt(((x[n.points] - n.centre) ** 2).sum(1))
        assert (far <= n.radius + 1e-9).all()
        if n.children:
            assert sorted(np.concatenate([c.points for c in n.children])) == sorted(n.points)
        return 1 + sum(map(check, n.children))

    assert check(tree) > 20


@pytest.mark.parametrize("dim", [3, 64])
def test_clusters_are_pruned(dim):
    """On 20 tight clusters fewer than half of all pairs are evaluated, within a block and between blocks."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, dim))
    x = centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, dim)) * 0.03
    x = np.floor(x * 256).astype(np.int64)
    ids, s, seen = np.arange(4000), topk.Settings(), []
    q = ids % 20 == 0
    score, who = topk.search(x[q], ids[q], x, ids, s, seen=seen)
    assert sum(seen) < 0.5 * q.sum() * 4000
    for i, row in enumerate(np.flatnonzero(q)):
        other = ids != row
        best = sorted(zip((-(x[other] @ x[row])).tolist(), ids[other].tolist(), strict=True))[:5]
        assert [(-a, b) for a, b in best] == list(zip(score[i].tolist(), who[i].tolist(), strict=True))
    middles = topk.learned_centres(x, 20)
    at, far = topk.nearest(x.astype(float), middles)
    radii = np.array([far[at == c].max(initial=0) for c in range(len(middles))])
    rows, to = topk.blocks_to_visit(x[q], score[:, -1], middles, radii, s)
    assert len(rows) < 0.5 * q.sum() * len(middles)


def test_equal_vectors_of_many_ids(spark):
    """More equal vectors than k: each query gets the smallest ids but its own."""
    df = spark.createDataFrame([(i, [1.0, 0.5], 0, "x", 0) for i in range(300)] + [(300 + i, [float(i % 7), 0.0], 0, "x", 0) for i in range(40)], SCHEMA).repartition(3)
    x = np.array([[1.0, 0.5]] * 300 + [[float(i % 7), 0.0] for i in range(40)])
    got = sorted(tuple(r) for r in topk.top_k(df, 10, s=topk.Settings(data_block=(16, 32))).collect())
    assert got == brute_top(x, np.arange(340), 10, 5)
    often = df.unionByName(df.where("vec_id = 0").crossJoin(spark.range(200)).drop("id"))
    got = sorted(tuple(r) for r in topk.top_k(often.where("vec_id < 300"), 170).collect())
    assert got == [(0, r, r, 81920) for r in range(1, 6)] + [(170, r, 0, 81920) for r in range(1, 6)]


def test_large_numbers():
    q, d = np.array([[2**28, -3]]), np.array([[2**28, 1], [2**28, 0], [-(2**28), 5]])
    score, ids = topk.search(q, np.array([9]), d, np.array([1, 2, 3]), topk.Settings(k=2))
    assert score.tolist() == [[2**56, 2**56 - 3]] and ids.tolist() == [[2, 1]]


def test_odd_queries(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0], None), (3, None, 1), (4, [math.nan, 0.0], 1), (10, [0.0, 0.0], 1), (None, [1.0, 1.0], 1), (0, [1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in topk.top_k(df, 10).collect())
    assert got == [(0, 1, 1, 65536), (0, 2, 2, 65536), (0, 3, 10, 0), (10, 1, 0, 0), (10, 2, 0, 0), (10, 3, 1, 0), (10, 4, 2, 0)]
    assert topk.top_k(df.limit(0), 10).count() == 0
    assert topk.top_k(df.where("vec_id = 10"), 10).count() == 0
