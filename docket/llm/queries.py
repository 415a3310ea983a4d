"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, embedding_dedup, hard_negatives, jaccard_join, language_model, mixing, quality, secrets, token_count, token_ids, topk_search, toxicity, whitening
from .common import shared_dir, table


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_ids.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), shared_dir(spark), end_id=2)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, docs, table(spark, sf_dir, "labels"), threshold=0.3)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.forest_for(docs))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), keep_ids=False)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(table(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), every=50)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(table(spark, sf_dir, "embeddings"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row has another row's label, as wrong labels would have."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), every=100)


QUERIES = {
    "op1_token_ids": op1_token_ids,
    "op2_token_counts": op2_token_counts,
    "op3_quality": op3_quality,
    "op4_mixing": op4_mixing,
    "op5_secret_scan": op5_secret_scan,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_whitening": op11_whitening,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_hard_negatives": op13_hard_negatives,
}

_REACH = """r(id, c) as (select id, id from nodes union select r.id, e.b from r join e on r.c = e.a)"""

ORACLE: dict[str, str] = {
    "op7_jaccard_join": rf"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) s from w),
n as (select doc_id, count(*) n from s group by doc_id),
p as (select x.doc_id a, y.doc_id b, count(*) k from s x join s y on x.s = y.s and x.doc_id < y.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)),
e as (select a, b from l union all select b, a from l),
nodes as (select doc_id id from documents),
{_REACH}
select id doc_id, coalesce(any_value(n), 0)::bigint n_shingles, min(c) component_id from r left join n on n.doc_id = id group by id""",
    "op8_embedding_near_dedup": rf"""
with recursive v as (select vec_id, label, embedding::double[] v, sqrt(list_inner_product(embedding::double[], embedding::double[])) m from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
l as (select x.vec_id a, y.vec_id b from v x join v y on x.label = y.label and x.vec_id < y.vec_id where x.m > 0 and y.m > 0 and list_inner_product(x.v, y.v) / (x.m * y.m) >= 0.98),
e as (select a, b from l union all select b, a from l),
nodes as (select vec_id id from embeddings),
k as (select a, count(*) k from e group by a),
{_REACH}
select id vec_id, coalesce(any_value(k), 0)::bigint n_links, min(c) component_id, id = min(c) kept from r left join k on k.a = id group by id""",
    "op10_exact_top_k": """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, d.vec_id, list_inner_product(q.v, d.v)::bigint score from v q join v d on q.vec_id <> d.vec_id where q.vec_id % 50 = 0)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5""",
    "op13_hard_negatives": """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end g, list_transform(embedding, lambda x: floor(256 * x::double)) v from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id anchor_id, a.g = d.g same, d.vec_id, list_inner_product(a.v, d.v)::bigint score from v a join v d on a.vec_id <> d.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, vec_id positive_id, score positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id)::int as rank, vec_id negative_id, positive_score, score negative_score
from p join s on s.anchor_id = p.anchor_id and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) <= 10""",
}
