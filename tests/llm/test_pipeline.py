"""The pipeline's stages, each against brute force on what the stage before it kept."""

import base64
import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from docket.llm import jaccard_join, mixing, quality, secrets
from docket.llm.common import table, written
from tests.llm.test_classifiers import plain_quality
from tests.llm.test_jaccard import plain_groups

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, DIR, "documents"), []
    out.append(docs)
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        docs = written(f(spark, docs, DIR), f"test{k}")
        out.append(docs)
    return [x.collect() for x in out]


def test_names_and_columns(spark, stages):
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    columns = table(spark, DIR, "documents").columns
    assert all(set(rows[0].asDict()) == set(columns) for rows in stages[:-1])


def test_quality(spark, stages):
    before, after = stages[0], stages[1]
    sample = quality.labelled_sample(table(spark, DIR, "documents"), table(spark, DIR, "labels"))
    model = quality.train(sample)
    score = {r.doc_id: plain_quality(model, r.text) for r in before}
    assert all(abs(p - 0.3) > 1e-4 for p in score.values())
    assert sorted(r.doc_id for r in after) == sorted(k for k, p in score.items() if p >= 0.3)
    labels = {r.doc_id: r.quality for r in table(spark, DIR, "labels").collect()}
    kept = {r.doc_id for r in after}
    good = [k for k, q in labels.items() if q == 1]
    assert sum(k in kept for k in good) >= 0.98 * len(good)


def test_near_copies(stages):
    before, after = stages[1], stages[2]
    want = {c for _, c in plain_groups([(r.doc_id, r.text) for r in before]).values()}
    assert {r.doc_id for r in after} == want and len(after) == len(want) < len(before)


def test_secrets(spark, stages):
    before, after = {r.doc_id: r for r in stages[2]}, {r.doc_id: r for r in stages[3]}
    assert before.keys() == after.keys()
    changed = [k for k in before if before[k].text != after[k].text]
    found = secrets.scan(spark.createDataFrame(stages[2]), secrets.forest_for(spark.createDataFrame(stages[2]))).where("n_secrets > 0").collect()
    assert sorted(changed) == sorted(r.doc_id for r in found)
    assert all(after[k].n_chars == len(after[k].text) for k in changed)


def test_mix(spark, stages):
    plan = {r.doc_id: r.copies for r in mixing.taken(spark.createDataFrame(stages[3])).collect()}
    assert Counter(r.doc_id for r in stages[4]) == Counter({k: c for k, c in plan.items() if c})


def test_ids(stages):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in stages[4]}
    assert Counter(r.doc_id for r in stages[5]) == Counter(r.doc_id for r in stages[4])
    for r in stages[5]:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows_pass_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, copies string"
    long = " ".join(f"word{i}" for i in range(20_000))
    rows = [(1, None, "en", "a", 0, 0.5, "x"), (2, "", "en", None, 0, 0.5, "x"), (None, "some words of a text", "en", "a", 20, 0.5, "x"), (4, long, "en", "b", len(long), 0.5, "x"), (4, long, "en", "b", len(long), 0.5, "x")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for k, (name, f) in enumerate(corpus_pipeline.STAGES):
            out = written(f(spark, docs, DIR), f"odd{k}")
            if k < 4:
                assert out.columns == docs.columns, name
            if k < 3:
                assert out.count() == len(data), name
            docs = out


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, DIR).count() == len(stages[5])
    assert jaccard_join.Settings().percent == 75
