"""From documents to token ids: good texts, one of each group of near copies, no secrets, mixed to target weights, encoded.

Every stage takes all that the one before it has kept, and is written and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docket.llm import bpe_codec, jaccard_join, mixing, quality, secrets
from docket.llm.common import scratch, table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier accepts; it learns from the labelled rows of sf_dir outside the held-out fold.

    Null and empty texts score by the classifier's own prior, repeated rows alike; an empty table gives no rows.
    """
    sample = quality.labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.accepted(docs, quality.train(sample), threshold=0.3)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id.

    Null and empty texts have no words, link with nothing and stay; texts are compared whole, however long; rows that
    repeat an id stay or go together; an empty table gives no rows.
    """
    return jaccard_join.representatives(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; what the forest takes for a secret is replaced by a mark. Null texts stay null, an empty table gives no rows."""
    return secrets.redact(docs, secrets.forest_for(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: not at all, once or twice. Null texts and texts without words come as often as
    their source's whole copies, equal rows equally often; an empty table gives no rows.
    """
    return mixing.mix(docs, weights=(5, 2, 1), share=1.5, most=2.0)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every row; ids as little-endian 32-bit integers.

    Null texts count as empty, repeated rows are all encoded, an empty table gives no rows.
    """
    return bpe_codec.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).drop("piece_offsets")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", without_near_copies),
    ("secret scans", without_secrets),
    ("mixing sources", mixed),
    ("byte-level BPE", encoded),
]

#: Classifier, forest and tokenizer can't be expressed in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir, each stage written and read again; an empty table gives no rows.

    Nulls, empty and long texts and repeated rows are what each stage says of them; further columns go along up to the last stage.
    """
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        with scratch(spark):
            docs = written(stage(spark, docs, sf_dir), f"stage{k}", keep=True)
    return docs
