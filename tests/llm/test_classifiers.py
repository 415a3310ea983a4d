"""Operators 3 and 9: held-out accuracy, and what has no plain answer."""

import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from docket.llm import quality, toxicity

ABUSE = ["grolbit", "snarfle", "wexly"]


def corpus(spark, n=600):
    """Every fifth text is junk (marks or one word again and again), every third has a word of abuse."""
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abdeilmnorstu") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for k in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(20, 80))]
        bad = k % 5 == 0
        if bad:
            words = [w + "***" for w in words] if k % 2 else [words[0]] * len(words)
        toxic = k % 3 == 0
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                words.insert(rnd.randrange(len(words)), rnd.choice(ABUSE) + rnd.choice(["", ",", "s"]))
        docs.append((k, " ".join(words), "x"))
        labels.append((k, int(not bad), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_held_out(spark):
    docs, labels = corpus(spark)
    s = quality.Settings(buckets=1 << 14, epochs=8)
    got = quality.classify(docs, docs, labels, s).join(labels, "doc_id").collect()
    assert len(got) == 600
    held = [r for r in got if r.held_out]
    assert all((crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in got)
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_quality_never_sees_held_out_labels(spark):
    docs, labels = corpus(spark, 200)
    s = quality.Settings(buckets=1 << 12, epochs=2)
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.labelled_sample(docs, labels, s) == quality.labelled_sample(docs, turned, s) != []


def plain_quality(model, text):
    """Average of all vectors of a text, softmax; feature by feature."""
    s = model.settings
    place = lambda x: 1 + crc32(x.encode()) % (s.buckets - 1)
    words = (text or "").split()
    at = [0]
    for w in words:
        at.append(place(w))
        at += [place(f"<{w}>"[i : i + n]) for n in (3, 4) for i in range(len(w) + 3 - n)]
    for a, b in zip(words, words[1:], strict=False):
        x, y = (crc32(w.encode()) for w in (a, b))
        h = (x * 0x9E3779B97F4A7C15 + y * 0xC2B2AE3D27D4EB4F) % 2**64
        h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 % 2**64
        h = quality.AGAIN if a == b else h
        at.append(1 + (h ^ h >> 29) % (s.buckets - 1))
    hidden = np.mean([model.vectors[i].astype(float) for i in at], axis=0)
    p = np.exp(hidden @ model.layer.astype(float))
    return p[1] / p.sum()


def test_quality_scores_equal_brute_force(spark):
    docs, labels = corpus(spark, 120)
    s = quality.Settings(buckets=1 << 12, epochs=3)
    model = quality.train(quality.labelled_sample(docs, labels, s), s)
    odd = [(1000, None, ""), (1001, "", ""), (1002, "ab ab ab  été\n***", ""), (1003, "x", "")]
    both = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    texts = {r.doc_id: r.text for r in both.collect()}
    got = quality.score_documents(both, model).collect()
    assert len(got) == 124 and all(abs(r.score - plain_quality(model, texts[r.doc_id])) < 1e-5 for r in got)
    kept = quality.accepted(both.withColumnRenamed("score", "k"), model).collect()
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in got if r.score >= 0.3)


def test_quality_sample_is_bounded(spark):
    """Repeated ids teach once, texts beyond the bound don't."""
    docs = spark.createDataFrame([(1, "a b " * 50_000), (1, "d"), (1, "d"), (1, "c"), (2, None), (3, "d e")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 1)], "doc_id long, quality int")
    want = {1: ("c", 1), 2: (None, 0), 3: ("d e", 1)}
    assert quality.labelled_sample(docs, labels) == [want[k] for k in (1, 2, 3) if crc32(str(k).encode()) % 5]


def test_quality_forgets_words(monkeypatch):
    """A worker that remembers few words scores alike."""
    rnd = random.Random(8)
    texts = [" ".join("w" + str(int(rnd.expovariate(0.1))) for _ in range(rnd.randint(0, 60))) for _ in range(200)]
    s = quality.Settings(buckets=1 << 12)
    weights = np.random.default_rng(1).normal(size=s.buckets)
    want = quality.Scorer(weights, s).scores(texts)
    for cache in (4, 10, 90):
        monkeypatch.setattr(quality, "CACHE", cache)
        assert np.allclose(quality.Scorer(weights, s).scores(texts), want)


def test_quality_edges(spark):
    docs, labels = corpus(spark, 100)
    s = quality.Settings(buckets=1 << 12, epochs=2, sample=50)
    assert len(quality.labelled_sample(docs, labels, s)) == 50
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (4, "x" * 50_000), (4, "x" * 50_000)], "doc_id long, text string")
    got = quality.classify(odd, docs, labels, s).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    none = quality.classify(odd, docs, labels.limit(0), s).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(odd.limit(0), docs, labels, s).count() == 0
    nulls = labels.select("doc_id", F.lit(None).cast("int").alias("quality"))
    assert quality.labelled_sample(docs, nulls, s) == []


def test_toxicity_held_out(spark):
    docs, labels = corpus(spark)
    s = toxicity.Settings(terms=40)
    got = toxicity.score_documents(docs, toxicity.learn(docs, labels, s)).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 600 and sum(r.predicted == r.toxic for r in held) / len(held) > 0.95


def plain_chain(chain, text):
    """Each category's probability from its own weights and those before it, term by term."""
    terms = {t for w in (text or "").split() for t in toxicity.terms_of(w, chain.settings)}
    out = []
    for k, (bias, *earlier) in enumerate(chain.heads):
        z = bias + sum(chain.weights[t][k] for t in terms if t in chain.weights) + sum(a * b for a, b in zip(earlier, out, strict=True))
        out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
    return out


def test_toxicity_scores_equal_brute_force(spark):
    docs, labels = corpus(spark, 240)
    chain = toxicity.learn(docs, labels, toxicity.Settings(terms=30))
    both = docs.unionByName(spark.createDataFrame([(1000, None, ""), (1001, "Grolbit!! SNARFLE é", "")], docs.schema))
    texts = {r.doc_id: r.text for r in both.collect()}
    for r in toxicity.score_documents(both, chain).collect():
        want = plain_chain(chain, texts[r.doc_id])
        assert np.allclose([r.p_widespread, r.p_rare, r.p_toxic], want) and r.predicted == int(want[2] >= 0.5)


def test_categories_are_marked_by_the_other_folds_terms(spark):
    """A term that one fold alone has marks nothing, and a row's categories don't depend on its own fold's labels."""
    docs, labels = corpus(spark, 400)
    s = toxicity.Settings(terms=40)
    words, y, _ = toxicity.labelled_sample(docs, labels, s)
    bags, fold = toxicity.Bags(words, s), toxicity.folds_of(words, s)
    marks = toxicity.abuse_labels(bags, y, fold, s)
    assert (marks[:, 2] == y).all() and (marks[:, :2].max(1) <= y).all()
    assert 0 < marks[:, 0].sum() and 0 < marks[:, 1].sum()
    assert (marks[:, 0] != marks[:, 1]).any() and (marks[:, 0] != y).any()
    first = int(np.flatnonzero((fold == 0) & (y == 1))[0])
    others = (fold == 0) & (np.arange(len(y)) != first)
    again = toxicity.abuse_labels(bags, np.where(others, 1 - y, y), fold, s)
    assert (again[first] == marks[first]).all()


def test_toxicity_sample_is_bounded(spark):
    docs = spark.createDataFrame([(k, "bad word " * 3) for k in (1, 1, 2, 3, 4)] + [(5, "long " * 20_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 6)], "doc_id long, toxic long")
    words, y, w = toxicity.labelled_sample(docs, labels)
    kept = [k for k in (1, 2, 3, 4) if crc32(str(k).encode()) % 5]
    assert words == [["bad", "word"]] * len(kept) and y.tolist() == [k % 2 for k in kept] and len(w) == len(kept)


def test_chain_uses_earlier_categories():
    rnd = random.Random(2)
    first = np.array([rnd.random() < 0.5 for _ in range(300)], int)
    texts = [("red " if a else "blue ") + f"w{rnd.randrange(50)}" for a in first]
    chain = toxicity.train(texts, np.stack([first, first], 1), np.ones(300), ("one", "two"))
    assert len(chain.heads[0]) == 1 and len(chain.heads[1]) == 2
    assert chain.heads[1][1] > 0
    score = toxicity.Scorer(chain).score
    assert score("red")[1] > 0.9 and score("blue")[1] < 0.1


def test_toxicity_edges(spark):
    docs, labels = corpus(spark, 120)
    chain = toxicity.learn(docs, labels, toxicity.Settings(terms=20))
    odd = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "grolbit", 1), (4, "snarfle " * 20_000, 1), (4, "snarfle " * 20_000, 1)], "doc_id long, text string, p_toxic int")
    got = toxicity.score_documents(odd, chain).collect()
    assert len(got) == 5 and {r.predicted for r in got if r.doc_id in (1, 2)} == {0}
    assert all(r.predicted == 1 for r in got if r.doc_id in (None, 4))
    for some in (labels.limit(0), labels.where("toxic = 0")):
        got = toxicity.score_documents(odd, toxicity.learn(docs, some)).collect()
        assert {r.predicted for r in got} == {0}
    assert toxicity.score_documents(odd.limit(0), chain).count() == 0


@pytest.mark.parametrize("word,terms", [("Idiots!!", ("idiots", "idio-", "idiot-", "idiots-")), ("***", ()), ("ab", ("ab",))])
def test_terms(word, terms):
    assert toxicity.terms_of(word, toxicity.Settings()) == terms
