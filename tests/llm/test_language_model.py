"""Operator 12: the base by brute force, the model as a distribution, and held-out texts."""

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from docket.llm import language_model as lm

SCHEMA = "doc_id long, text string, score string, row int"
SMALL = lm.Settings(words=60, classes=6, slots=4, rows=256, near=8, learn=40, batch=64)


def corpus(n, seed=0):
    """Texts of two tongues with words of their own, some rare; the tongue can be told from the words before."""
    rng = np.random.default_rng(seed)
    tongues = [[f"{c}{i}" for i in range(40)] for c in "xy"]
    texts = []
    for i in range(n):
        at = (rng.zipf(1.5, rng.integers(3, 40)) - 1) % 40
        texts.append(" ".join(tongues[i % 2][k] for k in at) + (f" Once{i}" if i % 5 == 0 else ""))
    return texts


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 0) for i, t in rows], SCHEMA).repartition(3)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + ["\n"]


def base(rows, folds=7, held=2):
    """(held_out, n_tokens, n_known, N, base) of each row."""
    left = [i is not None and crc32(str(i).encode()) % folds == held for i, _ in rows]
    count = Counter(t for (i, text), out in zip(rows, left, strict=True) if i is not None and not out for t in tokens(text))
    n, v = sum(count.values()), len(count)
    return [(out, len(tokens(t)), sum(w in count for w in tokens(t)), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t))) for (_, t), out in zip(rows, left, strict=True)]


@pytest.mark.parametrize("s", [SMALL, lm.Settings()])
def test_base_and_held_out(spark, s):
    rows = [*enumerate(corpus(400)), (1000, None), (1001, ""), (1002, "ÄÖ x1 X1\x0bx1\x85"), (1003, "x1 " * 30_000), (None, "x1 new"), (5, "x2 X2"), (5, "x2 X2")]
    got = lm.score_documents(frame(spark, rows), s).collect()
    key = lambda r: (str(r[0]), *r[1:4], round(r[5], 6))
    want = base(rows)
    assert sorted(map(key, got)) == sorted((str(i), out, n, k, round(b, 6)) for (i, _), (out, n, k, _, b) in zip(rows, want, strict=True))
    assert {r.train_tokens for r in got} == {want[0][3]}
    left = [r for r in got if r.held_out]
    assert sum(r.score for r in left) > 0.9 * sum(r.base_score for r in left) and all(r.score < 0 for r in got)
    assert len({round(r.score, 9) for r in got if r.doc_id == 5 and r.n_tokens == 3}) == 1


def test_without_training_rows(spark):
    rows = [(i, "some words") for i in range(200) if crc32(str(i).encode()) % 7 == 2]
    got = lm.score_documents(frame(spark, rows), SMALL).collect()
    assert {(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(True, 3, 0, 0, 0.0)} and all(math.isfinite(r.score) for r in got)
    assert lm.score_documents(frame(spark, rows).limit(0), SMALL).count() == 0


def model(spark, s=SMALL, n=300):
    rows = frame(spark, enumerate(corpus(n))).selectExpr("cast(doc_id as long) row", "cast(text as binary) text")
    counts = lm.word_counts(rows.select("text")).cache()
    known = lm.vocabulary(counts, s)
    encoded = lm.encode(rows, known).cache()
    at = lm.layout(known, lm.word_classes(encoded, known, s), s)
    return rows, counts, known, encoded, at, lm.train(encoded, known, at, s)


def test_probabilities_sum_to_one(spark):
    """Over all numbered words and the rare ones' class, after any context; rare words have shares of their class."""
    _, counts, known, _, at, w = model(spark)
    for context in ([known.start] * 3, [known.start, 4, 9], [3, known.rare, 1]):
        x = np.concatenate([np.array([*context, k, known.start, known.start, known.start], np.int32) for k in range(known.rare + 1)])
        each = lm.log_probabilities(x, w, at, SMALL)
        own = np.flatnonzero(x < len(at.classes))
        last = np.flatnonzero(np.isin(own, np.arange(known.rare + 1) * 7 + 3))
        assert abs(np.exp(each[last]).sum() - 1) < 1e-5
    rare = {r.word: r.n for r in counts.collect() if bytes(r.word) not in known.words}
    assert len(rare) > 20 and abs(sum(n + 1 for n in rare.values()) + 1 - known.rare_total) == 0


def test_scores_are_those_of_the_model(spark):
    """The whole query against the steps by hand, over plain softmaxes."""
    s = SMALL
    rows, counts, known, encoded, at, w = model(spark)
    number, count = {x: i for i, x in enumerate(known.words)}, {bytes(r.word): r.n for r in counts.collect()}
    got = {r.row: r.log for r in lm.scored(encoded, w, at, known, s).collect()}
    for r in rows.limit(20).collect():
        ids = [known.start] * 3 + [number.get(t, known.rare) for t in [*lm.words_of(bytes(r.text)), lm.END]]
        total = 0.0
        for k in range(3, len(ids)):
            one = np.array([[known.start] * 3 + ids[k - 3 : k + 1]]).ravel()
            own, c, slot, of_class, of_slot = lm.features(one, at, s)
            z = sum(w.classes[f[-1]].astype(float) for f in of_class) + w.classes[s.rows]
            y = sum(w.slots[f[-1]].astype(float) for f in of_slot)
            total += z[c[-1]] - np.log(np.exp(z).sum()) + y[slot[-1]] - np.log(np.exp(y).sum()) + at.tail[own[-1]]
        assert abs(got[r.row] - total / np.log(10)) < 1e-3
    assert count[lm.END] == 300


def test_training_follows_the_gradient(spark):
    """After training the texts are likelier than with the words' frequencies alone."""
    _, _, known, encoded, at, w = model(spark)
    total = lambda w: sum(r.log for r in lm.scored(encoded, w, at, known, SMALL).collect())
    assert total(w) > 0.93 * total(lm.Weights.first(at, SMALL))


def test_merging_weights_rows_by_their_use():
    s, at = lm.Settings(rows=2, classes=2, slots=2), lm.Layout(*(np.zeros(2, int),) * 2, np.zeros(2), np.zeros(2), np.zeros((2, 2)))
    w = lm.Weights.first(at, s)
    part = lambda used, change: np.concatenate([np.full(3, used), np.full(6, change * used), np.ones(3), np.zeros(4), np.zeros(8), np.zeros(4)])
    out = lm.merged(w, part(3.0, 1.0) + part(1.0, 5.0))
    assert np.allclose(out.classes, 2.0) and np.allclose(out.slots, 0) and np.allclose(out.energy[0], 2)


def test_a_step_sums_the_gradients_of_each_row():
    """Rows that are used once, a few times and very often, against one use after the other; two steps, so that energy counts."""
    rng = np.random.default_rng(1)
    s = lm.Settings(rows=64, slots=5)
    r = np.concatenate([np.zeros(500, int), np.repeat(np.arange(1, 20), np.arange(1, 20)), np.arange(20, 60)]).astype(np.int32)
    rng.shuffle(r)
    table, energy, used = np.zeros((64, 5), np.float32), np.zeros(64, np.float32), np.zeros(64, np.float32)
    want, squares = np.zeros((64, 5)), np.zeros(64)
    for _ in range(2):
        gradient = rng.normal(size=(len(r), 5)).astype(np.float32)
        lm._step(table, energy, used, [r], gradient, s)
        total = np.array([gradient[r == k].sum(0, dtype=float) for k in range(64)])
        squares += (total * total).sum(1)
        want -= s.rate * total / np.sqrt(1 + squares)[:, None]
    assert np.allclose(table, want, atol=1e-4) and np.allclose(energy, squares, rtol=1e-4) and (used == 2 * np.bincount(r, minlength=64)).all()


def test_rows_of_features_fit_any_number_of_rows():
    x = np.arange(1000)
    odd, even = (lm._rows(3, lm.Settings(rows=n), x, x + 1) for n in (1000, 1024))
    assert len(np.unique(odd)) > 500 and len(np.unique(even)) > 500 and odd.max() < 1000 and even.max() < 1024 and min(odd.min(), even.min()) >= 0


def test_a_step_sums_without_a_call_for_each_row_and_column(monkeypatch):
    """A batch's steps over many rows that are used once or twice: reduceat, which took most of the training, isn't called."""

    class Add:
        def __getattr__(self, name):
            assert name != "reduceat"
            return getattr(np.add, name)

    class Numpy:
        add = Add()

        def __getattr__(self, name):
            return getattr(np, name)

    monkeypatch.setattr(lm, "np", Numpy())
    r = np.repeat(np.arange(3000, dtype=np.int32), 2)
    lm._step(np.zeros((4096, 8), np.float32), np.zeros(4096, np.float32), np.zeros(4096, np.float32), [r], np.ones((6000, 8), np.float32), lm.Settings())
