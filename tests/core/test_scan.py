"""Running values against a plain loop, with keys that lie in many chunks."""

import random

import pytest

from docket.operators import scan


def rows(seed, n=400):
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 9)}", i, rnd.choice([None, rnd.randint(-5, 50)])) for i in range(n)]


@pytest.mark.parametrize("how", ["sum", "min"])
def test_running(spark, how):
    data = rows(1)
    want, so_far = {}, {}
    for k, i, v in data:
        if v is not None:
            so_far[k] = v if k not in so_far else so_far[k] + v if how == "sum" else min(so_far[k], v)
        want[i] = so_far.get(k)
    df = spark.createDataFrame(data, "k string, i int, v long").repartition(5)
    assert {r.i: r.out for r in scan.running(df, ["k"], ["i"], "v", "out", how, width=16).collect()} == want


def test_latest(spark):
    data, asks = rows(2), [(k, a, f"x{a}") for k in ("hot", "k1", "none") for a in (-1, 0, 57, 399, 1000)]
    want = {(k, a): min((v for q, i, v in data if q == k and i < a and v is not None), default=None) for k, a, _ in asks}
    df, ask = spark.createDataFrame(data, "k string, i int, v long"), spark.createDataFrame(asks, "k string, i int, x string")
    got = {(r.k, r.i): (r.least, r.x) for r in scan.latest(df, ask, ["k"], "i", "v", "least", "min", width=16).collect()}
    assert got == {(k, a): (v, f"x{a}") for (k, a), v in want.items()}


def test_empty(spark):
    df = spark.createDataFrame([], "k string, i int, v long")
    assert scan.running(df, ["k"], ["i"], "v", "out").count() == scan.latest(df, df.select("k", "i"), ["k"], "i", "v", "out").count() == 0
