"""Operator 11 against brute force in numpy and whole numbers."""

import math

import numpy as np
import pytest

from docket.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string, n int, x int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", 0, 1) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, scale=64, shift=1_000_000, most=16):
    kept = [(i, [math.floor(scale * float(c)) + shift for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max(len(v) for _, v in kept)
    kept = [(i, tuple(v + [shift] * (dim - len(v)))) for i, v in kept]
    listed = sorted(set(v for _, v in kept))
    n, sums = len(listed), [sum(c) for c in zip(*listed, strict=True)]
    y = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in listed])
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for _, v in kept]
    z = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for _, v in kept]) @ vectors / np.sqrt(np.maximum(values, 1e-300))
    return kept, n, deviation, z, values / np.trace(cov)


@pytest.mark.parametrize("dim", [5, 24])
def test_components(spark, dim):
    rng = np.random.default_rng(dim)
    x = (rng.normal(size=(400, dim)) * np.linspace(3, 1, dim) + 5).astype(np.float32)
    x[200:260] = x[:60]  # copies count once in the fit
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(7, x[7].tolist()), (None, x[8].tolist()), (500, None), (501, [None] * dim), (502, [math.nan] * dim), (503, [math.inf] * dim)]
    kept, n, deviation, z, explained = brute(rows)
    got = whitening.components(frame(spark, rows)).collect()
    assert len(got) == len(kept) * min(16, dim) and {r.n for r in got} == {n}
    assert sorted(((r.vec_id, r.deviation) for r in got if r.component == 1), key=str) == sorted([(i, d) for (i, _), d in zip(kept, deviation, strict=True)], key=str)
    found = {}
    for r in got:
        found.setdefault(r.vec_id, {})[r.component - 1] = r.whitened
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and 0 <= r.identity_error < 1e-9
    mine = np.array([[found[i][k] for k in range(z.shape[1])] for i, _ in kept])
    turn = np.sign((mine * z).sum(0))
    assert np.abs(mine - z * turn).max() < 1e-6


def test_short_vectors_are_filled_up(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0]), (3, [1.0, 0.0]), (4, [3.0, -1.0]), (5, [])]
    kept, n, deviation, z, _ = brute(rows)
    got = whitening.components(frame(spark, rows)).collect()
    assert n == 4 and {r.n for r in got} == {4} and len(got) == 10
    assert {(r.vec_id, r.deviation) for r in got} == {(i, d) for (i, _), d in zip(kept, deviation, strict=True)}


def test_without_variance(spark):
    """Equal vectors have no component with variance; a flat direction has none either."""
    got = whitening.components(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, None, None, None)] * 4
    flat = whitening.components(frame(spark, [(i, [float(i), 1.0]) for i in range(6)])).collect()
    assert {r.component for r in flat if r.whitened is None} == {2} and {r.explained for r in flat} == {1.0, 0.0}
    assert whitening.components(frame(spark, [(1, None)])).count() == whitening.components(frame(spark, [(1, [])])).count() == 0
    assert whitening.components(frame(spark, []).limit(0)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_numbers(spark):
    """Sums and deviations are exact beyond 2^53, and null beyond 64 bits; what 64 bits can't hold takes no part."""
    rows = [(1, [2.0**24, 1.0]), (2, [-(2.0**24), 3.0]), (3, [2.0**23 + 1, 0.0]), (4, [2.0**60, 0.0])]
    got = {r.vec_id: r.deviation for r in whitening.components(frame(spark, rows)).collect()}
    kept, _, deviation, *_ = brute(rows[:3])
    assert got == {i: d if d < 2**63 else None for (i, _), d in zip(kept, deviation, strict=True)} and max(deviation) > 2**53
    wide = [(1, [2.0**40]), (2, [-(2.0**40)])]
    assert {r.deviation for r in whitening.components(frame(spark, wide)).collect()} == {None}


def test_model_projects_other_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 6)).astype(np.float32)
    model = whitening.fit(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]))
    other = whitening.whiten(frame(spark, [(9, x[3].tolist()), (10, [*x[3].tolist(), 4.0])]), model).collect()
    assert np.allclose(other[0].whitened, other[1].whitened)
    assert np.allclose(other[0].whitened, model.project(np.floor(64 * x[3:4].astype(float)).astype(np.int64) + 1_000_000)[0])
