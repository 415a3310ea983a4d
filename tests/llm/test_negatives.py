"""Operator 13 against brute force."""

import math

import numpy as np
import pytest

from docket.llm import hard_negatives as hard
from tests.llm.test_vectors import SCHEMA, clustered, frame


def brute(x, labels, every, s, ids=None):
    v = np.floor(256.0 * x.astype(float)).astype(np.int64)
    ids = np.arange(len(x)) if ids is None else ids
    out = []
    for i in np.flatnonzero(ids % every == 0):
        score = v @ v[i]
        best = sorted((-score[j], ids[j]) for j in range(len(x)) if labels[j] == labels[i] and ids[j] != ids[i])[: s.positives]
        for p, who in best:
            window = sorted((-score[j], ids[j]) for j in range(len(x)) if labels[j] != labels[i] and s.low * -p <= 100 * score[j] <= s.high * -p)[: s.k]
            out += [(int(ids[i]), int(who), r + 1, int(b), int(-p), int(-a)) for r, (a, b) in enumerate(window)]
    return sorted(out)


@pytest.mark.parametrize("s", [hard.Settings(), hard.Settings(positives=3, k=4, low=50, high=99, leaf=8, block=(40, 64), sample=300, slice=3, at_once=2)])
def test_mined(spark, s):
    x, labels = clustered(700, 5)
    got = sorted(tuple(r) for r in hard.mine(frame(spark, x, labels), 10, s=s).collect())
    want = brute(x, labels, 10, s)
    assert got == want and len(want) > 500


def test_many_equal_vectors(spark):
    """More copies than are wanted, of both labels; copies of an anchor are its positives."""
    rng = np.random.default_rng(2)
    x = np.vstack([np.tile([1.0, 0.5, 0.0], (400, 1)), np.tile([0.5, 0.2, 0.0], (300, 1)), rng.normal(size=(100, 3))]).astype(np.float32)
    labels = np.array([i % 2 for i in range(400)] + [i % 3 for i in range(300)] + [5] * 100)
    s = hard.Settings(block=(32, 64), leaf=8)
    assert sorted(tuple(r) for r in hard.mine(frame(spark, x, labels), 50, s=s).collect()) == brute(x, labels, 50, s)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5], 2), (3, None, 1), (4, [math.nan, 0.0], 2), (5, [0.6, 0.0], None), (None, [0.6, 0.0], 2), (10, [-1.0, 0.0], 1), (20, [0.0, 0.0], 3), (2, [0.5], 2), (0, [1.0, 0.0], 1), (30, [], 4)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in hard.mine(df, 10).collect())
    assert got == [(0, 1, 1, 2, 65536, 32768), (0, 1, 2, 2, 65536, 32768)]  # a negative positive score has an empty window; 20 and 30 have no positive
    assert hard.mine(df.limit(0), 10).count() == hard.mine(df.where("vec_id = 3"), 10).count() == 0
    assert hard.mine(df.limit(0), 10).columns == hard.mine(df, 10).columns


def test_traversal_is_incremental():
    """Rows come nearest first, and the first few don't need most of the leaves."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 8))
    x = np.floor(256 * (centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 8)) * 0.02)).astype(np.int64)
    most = float((x * x).sum(1).max())
    block = hard.Block(x, np.arange(4000), rng.integers(0, 4, 4000), most, hard.Settings(leaf=32))
    bottom, top = hard.score_bounds(block.tree, hard.augmented(x[:40], 0.0), most, 8)
    opened = []
    for i in range(40):
        score = x @ x[i]
        high = int(0.9 * score[i])
        of = block.scores(x[i])
        rows = hard.nearest_first(block.tree, bottom[i], top[i], -(10**9), high, lambda k, of=of: opened.append(k) or of(k), np.full(4000, True), block.ids)
        want = sorted((-a, j) for j, a in enumerate(score.tolist()) if a <= high)[:10]
        assert [next(rows) for _ in range(10)] == [(-a, j) for a, j in want]
    assert len(opened) < 0.3 * 40 * (block.tree.vantage < 0).sum()


def test_bounds_hold():
    rng = np.random.default_rng(6)
    x = np.floor(256 * rng.normal(size=(500, 6))).astype(np.int64)
    most = float((x * x).sum(1).max())
    built = hard.augmented(x, most)
    for tree in (hard.build(built, 16, slack=1e-6 * most**0.5), hard.open_ranges(hard.build(built, 16))):
        bottom, top = hard.score_bounds(tree, hard.augmented(x[:50], 0.0), most, 6)
        score = x[:50] @ x.T
        for k in range(len(tree.parent)):
            own = score[:, tree.order[tree.start[k] : tree.stop[k]]]
            assert (own.max(1) <= top[:, k]).all() and (own.min(1) >= bottom[:, k]).all()
        at = hard.cells_of(tree, built)
        assert all(tree.start[k] <= p < tree.stop[k] for k, p in zip(at, np.argsort(tree.order), strict=True))


def test_large_numbers():
    block = hard.Block(np.array([[2**28, 1], [2**28, 0], [-(2**28), 5]]), np.array([1, 2, 3]), np.array([0, 0, 0]), float(2**57), hard.Settings())
    got = next(block.search(np.array([[2**28, -3]]), np.array([9]), np.array([0]), [[(hard.LEAST, hard.MOST)]], 2, True))
    assert got == [[(2**56, 2), (2**56 - 3, 1)]]
