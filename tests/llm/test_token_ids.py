"""Operator 1: codes, whole files and the library's ids."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docket.llm import token_ids
from docket.llm.common import shared_dir

PATH = P.path("word_bpe_49k.json")
PARTS = [" ", "  ", "\n", "\t", "Ab", "c's", "'LL", "x1", "É", "é", "́", "İ", "Σ", "日本", "<|endoftext|>", "!", "\xa0", "\x1c", "the", "\x00", "ǆ", "€", "...", ">", "|", "a.b", "¿", "Ñ,"]


@given(st.lists(st.lists(st.integers(0, 2**32 - 1)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_round_trip(lists):
    n = np.array([len(x) for x in lists], np.int64)
    flat = np.array([r for x in lists for r in x], np.uint32)
    c, d, sizes = token_ids.pack(flat, n)
    assert len(c) == (-(-n // 4)).sum() and len(d) == sizes.sum()
    assert token_ids.unpack(c, d, n).tolist() == flat.tolist()
    for x, own_c, own_d in zip(lists, token_ids.cut(c, -(-n // 4)), token_ids.cut(d, sizes), strict=True):
        assert token_ids.unpack(own_c, own_d, np.array([len(x)])).tolist() == x


def texts(n):
    rnd = random.Random(3)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 12))) for _ in range(n)]


def test_words_equal_library():
    t, w = Tokenizer.from_file(PATH), token_ids.Words(PATH)
    some = texts(3000)
    ids, n = w.encode(pa.array(some))
    for x, own in zip(some, np.split(ids, np.cumsum(n)[:-1]), strict=True):
        assert own.tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


def test_files(spark, monkeypatch):
    t = Tokenizer.from_file(PATH)
    some = texts(300) + [None, "", "word " * 3000]
    rows = [(k * 7 % 1009, x, 5) for k, x in enumerate(some)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(5)
    out = f"{shared_dir(spark)}/t1"
    monkeypatch.setattr(token_ids, "BLOCK", 50)
    token_ids.write_ids(df, PATH, out, 2, shards=3)
    got = {r.doc_id: r for r in token_ids.read_ids(spark, out).collect()}
    start = 0
    for k, x, _ in sorted(rows):
        want = np.array([*(t.encode(x, add_special_tokens=False).ids if x else []), 2], "<u4")
        r = got[k]
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (start, len(want), zlib.crc32(want.tobytes()), want.tobytes())
        start += len(want)
    ranks = spark.read.parquet(f"{out}/ranks").orderBy("rank").collect()
    assert [r.n for r in ranks] == sorted((r.n for r in ranks), reverse=True)
    assert sum(r.n for r in ranks) == start


def test_edges(spark):
    schema = "doc_id long, text string"
    assert token_ids.round_trip(spark.createDataFrame([], schema), PATH, shared_dir(spark)).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], schema)
    got = sorted((r.start, r.n_tokens, r.doc_id) for r in token_ids.round_trip(twice, PATH, shared_dir(spark)).collect())
    assert got == [(0, 2, None), (2, 3, 1), (5, 3, 1)]


def test_a_task_has_one_shard(spark, tmp_path):
    """Shards are near each other in size, and each is written by a task of its own."""
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(["word"] * int(n))) for i, n in enumerate(rng.integers(1, 30, 3000))]
    out = f"{tmp_path}/files"
    token_ids.write_ids(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), PATH, out, 2, shards=32)
    files = spark.read.parquet(f"{out}/blocks").groupBy(F.input_file_name().alias("f")).agg(F.collect_set("shard").alias("shards"), F.sum("tokens").alias("n")).collect()
    assert len(files) == 32 and all(len(r.shards) == 1 for r in files)
    mean = sum(r.n for r in files) / 32
    assert max(r.n for r in files) < 1.6 * mean
