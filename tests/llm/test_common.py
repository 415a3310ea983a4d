"""Components by one task and by rounds of joins give the same."""

import random

import pytest

from docket.llm.common import components


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    return {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}


@pytest.mark.parametrize("at_once", [0, 500_000])
@pytest.mark.parametrize("kind", ["random", "path", "star", "empty"])
def test_components(spark, kind, at_once):
    rnd = random.Random(6)
    edges = {
        "random": [(rnd.randrange(120), rnd.randrange(120)) for _ in range(90)],
        "path": [(i + 1, i) for i in range(40)],
        "star": [(7, i) for i in range(60)],
        "empty": [],
    }[kind]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(df, at_once=at_once).collect()}
    assert got == plain(edges)


def test_scratch_removes_what_is_not_kept(spark):
    from pathlib import Path

    from docket.llm.common import scratch, shared_dir, written

    there = lambda: {p.name.split("-")[1] for p in Path(shared_dir(spark).removeprefix("file:")).glob("docket-s?scope-*")}
    with scratch(spark):
        written(spark.range(3), "s1scope")
        with scratch(spark):
            written(spark.range(3), "s2scope")
            inner = written(spark.range(3), "s3scope", keep=True)
        assert there() == {"s1scope", "s3scope"} and inner.count() == 3
        kept = written(spark.range(4), "s4scope", keep=True)
    assert there() == {"s4scope"} and kept.count() == 4
