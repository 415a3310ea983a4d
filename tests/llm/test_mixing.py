"""Operator 4: targets against a plain loop, and what rounding must keep."""

import random
import re
from collections import defaultdict

import pytest

from docket.llm import mixing


def plain_targets(sizes, weights, share, most):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        t = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] > most * sizes[s]]
        if not over:
            return capped | t
        capped |= {s: most * sizes[s] for s in over}


def rows(n, seed, sources):
    rnd = random.Random(seed)
    return [(k, " ".join("w" * rnd.randint(1, 3) for _ in range(int(rnd.paretovariate(0.8)) % 3000)), rnd.choice(sources)) for k in range(n)]


@pytest.mark.parametrize("n,seed,sources", [(400, 1, ["b", "a", None, "é", "B"]), (3000, 2, ["x", "x", "x", "y"]), (30, 3, ["a", "b", "c", "d"]), (5, 4, ["q"])])
def test_near_targets(spark, n, seed, sources):
    data = rows(n, seed, sources)
    df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3)
    got = mixing.taken(df).collect()
    assert sorted(r.doc_id for r in got) == list(range(n))
    by = {d: s for d, _, s in data}
    words = {d: len(re.findall(mixing.WORD, t)) for d, t, _ in data}
    sizes = defaultdict(int)
    for d, _, s in data:
        sizes[s] += words[d]
    want = plain_targets(dict(sizes), (5, 2, 1), 1.5, 2.0)
    taken = defaultdict(int)
    for r in got:
        s = by[r.doc_id]
        assert (r.size, r.source_size) == (words[r.doc_id], sizes[s])
        assert r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s, t in want.items():
        largest = max(words[d] for d in by if by[d] == s)  # one that outweighs the others can't be made up for
        assert abs(taken[s] - t) <= (0.01 * sizes[s] + 2 if largest < 0.2 * sizes[s] else largest)
    again = mixing.taken(df.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_chances_are_kept(spark):
    """Over many seeds a document is taken as often as its source's ratio says."""
    data = [(k, "w " * (3 + 40 * (k % 7 == 0)), "a") for k in range(40)] + [(100 + k, "w " * 20, "b") for k in range(20)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").coalesce(1)
    total, runs = defaultdict(float), 12
    for seed in range(runs):
        for r in mixing.taken(df, share=0.6, seed=seed).collect():
            total["a" if r.doc_id < 100 else "b"] += r.taken / runs
            ratio = r.target / r.source_size
            assert r.copies in (int(ratio), int(ratio) + 1)
    assert total["a"] + total["b"] == pytest.approx(0.6 * (40 * 3 + 6 * 40 + 400), rel=0.03)


def test_edges(spark):
    schema = "doc_id long, text string, source string, size string, target int"
    assert mixing.taken(spark.createDataFrame([], schema)).count() == 0
    odd = [(1, None, "a", "x", 1), (2, "", None, "x", 1), (None, "a b", "a", "x", 1), (4, "w " * 30_000, "b", "x", 1), (4, "w " * 30_000, "b", "x", 1), (4, "other", "c", "x", 1)]
    got = mixing.taken(spark.createDataFrame(odd, schema)).collect()
    assert len(got) == 6
    assert {r.taken for r in got if r.size == 0} == {0}
    assert {r.size for r in got if r.doc_id == 4} == {30_000, 1}
    again = spark.createDataFrame([(7, "w w w", "a", "x", 1)] * 5000 + [(8, "w w", "a", "x", 1)] * 2, schema)
    got = mixing.taken(again, share=1.0).collect()
    assert len(got) == 5002 and len({r.taken for r in got if r.doc_id == 7}) == 1


def test_mix_repeats_rows(spark):
    data = rows(300, 9, ["a", "b", None])
    df = spark.createDataFrame([(*r, "keep") for r in data], "doc_id long, text string, source string, copies string")
    plan = {r.doc_id: r.copies for r in mixing.taken(df).collect()}
    got = defaultdict(int)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    for r in mixed.collect():
        got[r.doc_id] += 1
        assert r.copies == "keep"
    assert all(got[k] == c for k, c in plan.items())


def test_no_python(spark):
    df = spark.createDataFrame(rows(50, 1, ["a", "b"]), "doc_id long, text string, source string")
    plan = mixing.taken(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
