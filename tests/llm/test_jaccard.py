"""Operator 7 against all pairs."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docket.llm import jaccard_join as join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def plain_groups(docs):
    sets = [(k, plain_set(t)) for k, t in docs]
    root = {k: k for k, _ in docs}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {k: (len(x), find(k)) for k, x in sets}


def corpus(seed, n=160):
    """Loose texts, chains of edited copies, a passage that many texts share, exact copies, short texts."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdéß") for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    prose = lambda m: [rnd.choice(words) for _ in range(m)]
    passage, docs = prose(60), []
    while len(docs) < n:
        kind = rnd.random()
        if kind < 0.3 or not docs:
            t = prose(rnd.randint(0, 120))
        elif kind < 0.5:
            t = prose(rnd.randint(0, 60)) + passage + prose(rnd.randint(0, 60))
        elif kind < 0.6:
            t = prose(rnd.randint(0, 6))
        else:
            t = rnd.choice(docs)[:]
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
                if t:
                    t[rnd.randrange(len(t))] = rnd.choice(words)
            if rnd.random() < 0.3:
                t = [w.upper() if w.isascii() else w for w in t]
        docs.append(t)
    ids = rnd.sample(range(10_000), n)
    return [(i, rnd.choice([" ", "\n", " \t"]).join(t)) for i, t in zip(ids, docs, strict=True)]


def edited_copies(seed, n=150):
    """One text of 140 words in copies from hardly to heavily edited, of which about half link with none; some share a passage only."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(7)) for _ in range(4000)]
    first = [rnd.choice(words) for _ in range(140)]
    docs = [first]
    while len(docs) < n:
        t = first[:]
        for _ in range(rnd.choice([1, 2, 3, 4, 5, 6, 8, 12])):
            t[rnd.randrange(len(t))] = rnd.choice(words)
        docs.append(t if rnd.random() < 0.9 else [rnd.choice(words) for _ in range(30)] + t[:80])
    ids = rnd.sample(range(10_000), n)
    return [(i, " ".join(t)) for i, t in zip(ids, docs, strict=True)]


@pytest.mark.parametrize("seed,s", [(1, join.Settings(meetings=0, large=2, sample=0)), (2, join.Settings(meetings=0, large=1, cost=0, verify=9.0, block=1000)), (3, join.Settings(meetings=0, rounds=0, firsts=1)), (4, join.Settings())])
def test_crowded_elements(spark, monkeypatch, seed, s):
    """A group far larger than the meetings allowed: hubs and barred documents change no link."""
    barred = []
    plain = join.barred_from

    def noted(*a):
        out = plain(*a)
        barred.extend(out.collect())  # the table goes with the operator's scratch
        return out

    monkeypatch.setattr(join, "barred_from", noted)
    docs = edited_copies(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join.groups(df, s).collect()}
    assert got == plain_groups(docs)
    if s.meetings == 0:
        sets = {k: plain_set(t) for k, t in docs}
        members = {}
        for k, (_, c) in got.items():
            members.setdefault(c, []).append(k)
        rows = barred
        assert rows and all(100 * len(sets[r.id] & sets[m]) < 75 * len(sets[r.id] | sets[m]) for r in rows for bar in r.bars for m in members[got[bar][1]] if got[r.id][1] != got[bar][1])


def test_representatives_keep_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "x", 1), (2, "a b c d e f", "y", 2), (3, "other", None, 3)], "doc_id long, text string, gone string, component_id int")
    out = join.representatives(df)
    assert out.columns == df.columns and sorted(tuple(r) for r in out.collect()) == [(1, "a b c d e f", "x", 1), (3, "other", None, 3)]


@pytest.mark.parametrize("seed,s", [(1, join.Settings()), (2, join.Settings(cost=0, firsts=1)), (3, join.Settings(cost=2, firsts=1, common=40)), (4, join.Settings(broadcast=8, cost=1, sample=20)), (6, join.Settings(meetings=0, crowd=2, sample=0, firsts=1, cost=1))])
def test_equals_all_pairs(spark, seed, s):
    docs = corpus(seed)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, n string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join.groups(df, s).collect()}
    assert got == plain_groups(docs)


def test_step_two_alone(spark):
    """Without stars (firsts=0 elements) every link must come from the prefixes."""
    docs = corpus(5, 100)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join.groups(df, join.Settings(firsts=0, cost=0)).collect()}
    assert got == plain_groups(docs)


def test_edges(spark):
    long = "word%d " * 1 % 1 + " ".join(f"w{i}" for i in range(50_000))
    rows = [(5, None, 1), (6, "", 1), (7, " \n", 1), (None, "a b c", 1), (8, "a b c", 1), (9, "A  b\tc", 1), (9, "A  b\tc", 1), (10, "a b", 1), (11, long, 1), (12, long + " end", 1), (3, "x y z q", 1), (3, "other words here now", 1), (4, "other words here now", 1), (2, "x y z q", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in join.groups(df).collect()), key=str)
    size = len(plain_set(long))
    want = [(5, 0, 5), (6, 0, 6), (7, 0, 7), (None, 1, None), (8, 1, 8), (9, 1, 8), (9, 1, 8), (10, 1, 10), (11, size, 11), (12, size + 1, 11), (3, 1, 2), (3, 1, 2), (4, 1, 2), (2, 1, 2)]
    assert got == sorted(want, key=str)
    assert join.groups(df.limit(0)).count() == 0
    kept = sorted(str(r.doc_id) for r in join.representatives(df).collect())
    assert kept == sorted(["5", "6", "7", "None", "8", "10", "11", "2"])
    assert join.representatives(df).columns == df.columns


def test_texts_of_an_id_need_the_least(spark):
    """Meetings of one pair of ids through texts that need 1 and 3, in either order."""
    rows = [(1, 2, 3), (1, 2, 1), (3, 4, 1), (3, 4, 3), (5, 6, 3), (5, 6, 3), (7, 8, 2), (7, 8, 2)]
    met = spark.createDataFrame(rows, "id1 long, id2 long, need int").coalesce(1)
    assert sorted((r.id1, r.id2) for r in join.often(met).collect()) == [(1, 2), (3, 4), (7, 8)]


@given(st.lists(st.text(alphabet="abAB \n\té\xa0", max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_sets_have_right_sizes(texts):
    import numpy as np

    with np.errstate(over="ignore"):
        sets = join.Shingler(5).sets([t.encode() for t in texts])
    assert [len(x) for x in sets] == [len(plain_set(t)) for t in texts]
    for a, x in zip(texts, sets, strict=True):
        for b, y in zip(texts, sets, strict=True):
            assert len(np.intersect1d(x, y)) == len(plain_set(a) & plain_set(b))
