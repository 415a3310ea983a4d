"""Operators 2 and 6 against the libraries they must equal."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from tokenizers import Tokenizer

from docket.llm import bpe_codec, token_count

PARTS = [" ", "  ", "\n", "\t", "a", "b", "'s", "'ll", "'", "''", "x1", "1", "é", "ß", "日本", "<|endoftext|>", "'v", "!", "\xa0", "\x85", "\x1c", " the", "the", "́", "🙂", "\x00", "'re", "'r", "​", "Ⅷ", "²"]
JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def mixed(n):
    rnd = random.Random(7)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_counts_equal_library():
    t, c = Tokenizer.from_file(JSON), token_count.Counter(JSON)
    for x in mixed(3000):
        assert c.count(x) == len(t.encode(x, add_special_tokens=False).ids), repr(x)


def test_ids_equal_library(library):
    c, texts = bpe_codec.Codec(RANKS), mixed(3000)
    for x, (ids, at) in zip(texts, c.encode(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(x), repr(x)
        assert c.decode(ids) == x.encode()
        assert list(at) == sorted(set(at)) and (not x or at[0] == 0)


@given(st.lists(st.text(max_size=30), max_size=5))
@settings(max_examples=150, deadline=None)
def test_any_text(library, texts):
    c = bpe_codec.codec(RANKS)
    for x, (ids, _) in zip(texts, c.encode(texts) if texts else [], strict=True):
        assert ids.tolist() == library.encode_ordinary(x)


def test_long_piece(library):
    c, x = bpe_codec.codec(RANKS), "ab" * 40_000 + " " * 5000 + "日" * 3000
    assert c.encode([x])[0][0].tolist() == library.encode_ordinary(x)
    t = Tokenizer.from_file(JSON)
    assert token_count.counter(JSON).count(x) == len(t.encode(x, add_special_tokens=False).ids)


def test_small_cache(monkeypatch):
    monkeypatch.setattr(token_count, "CACHE", 4)
    t, c = Tokenizer.from_file(JSON), token_count.Counter(JSON)
    for x in ["a b c d e f g a b c", "h i j k a"]:
        assert c.count(x) == len(t.encode(x, add_special_tokens=False).ids)


def rows(spark):
    return spark.createDataFrame([Row(doc_id=1, text="Hello there", n_tokens=9, k="x"), Row(doc_id=2, text=None, n_tokens=9, k="x"), Row(doc_id=None, text="", n_tokens=9, k=None), Row(doc_id=1, text="Hello there", n_tokens=9, k="x")], "doc_id long, text string, n_tokens int, k string")


def test_edges(spark, library):
    for df, f in ((rows(spark), lambda d: token_count.count_tokens(d, JSON)), (rows(spark), lambda d: bpe_codec.encode_documents(d, RANKS))):
        got = sorted(((r.doc_id or -1), r.n_tokens) for r in f(df).collect())
        assert got == [(-1, 0), (1, 2), (1, 2), (2, 0)]
        assert f(df.limit(0)).count() == 0
    one = bpe_codec.encode_documents(rows(spark), RANKS).where("doc_id = 1").first()
    ids = library.encode_ordinary("Hello there")
    assert np.frombuffer(one.ids, "<u4").tolist() == ids
    assert one.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert one.decoded_sha256 == hashlib.sha256(b"Hello there").hexdigest()
    assert np.frombuffer(one.piece_offsets, "<u4").tolist() == [0, 5]
    assert token_count.count_tokens(rows(spark), JSON, limit=1).where("over_limit").count() == 2
