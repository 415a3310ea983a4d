"""Quality classifier: supervised subword embeddings (operator 3).

A document is the average of learned vectors of its hashed words, of their
character n-grams and of its word bigrams; a softmax layer on top gives the
probability. Vectors and layer are trained by stochastic gradient descent in numpy.
For scoring, each vector's product with the layer is a number, so that a text costs
a look-up per word and per bigram.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Words that a worker remembers; beyond that it forgets those that it hasn't met for longest.
CACHE = 160_000
#: Stands for "the word before again".
AGAIN = 0x5851F42D4C957F2D
Bag = tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18  # rows of the table of vectors
    dim: int = 8
    low: int = 3  # lengths of character n-grams, word ends marked
    high: int = 4
    epochs: int = 8
    rate: float = 1.0
    seed: int = 11
    sample: int = 3000  # labelled documents that are learned from
    longest: int = 1 << 16  # bytes of a text that is learned from, at most


def features(word: str, s: Settings) -> list[int]:
    """Buckets of the word and of its character n-grams; bucket 0 is every document's own."""
    edged, size = f"<{word}>", s.buckets - 1
    out = [1 + crc32(word.encode("utf-8", "surrogatepass")) % size]
    for n in range(s.low, s.high + 1):
        out += [1 + crc32(edged[i : i + n].encode("utf-8", "surrogatepass")) % size for i in range(len(edged) - n + 1)]
    return out


def bigrams(codes: np.ndarray, s: Settings) -> np.ndarray:
    """Buckets of the bigrams of a sequence of words, given by the words' codes.

    A word after itself is written as a reference back, so that all words' repetitions are one bigram: as
    pairs of two words they would be learned for each word anew.
    """
    codes = codes.astype(np.uint64)
    h = codes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = np.where(codes[:-1] == codes[1:], np.uint64(AGAIN), h)
    return 1 + ((h ^ (h >> np.uint64(29))) % np.uint64(s.buckets - 1)).astype(np.int64)


class Words:
    """Numbers for words, given in order of appearance, with what is known of each."""

    def __init__(self, s: Settings) -> None:
        self.settings, self.at = s, {}
        self.codes, self.buckets = [], []

    def numbers(self, words: list[str]) -> list[int]:
        at = self.at
        for w in words:
            if w not in at:
                at[w] = len(at)
                self.codes.append(crc32(w.encode("utf-8", "surrogatepass")))
                self.buckets.append(features(w, self.settings))
        return [at[w] for w in words]


def bag(text: str | None, s: Settings) -> Bag:
    """(buckets, shares) of a text, ascending; shares sum to 1."""
    known = Words(s)
    every = [0]
    at = known.numbers((text or "").split())
    if at:
        every += [b for k in at for b in known.buckets[k]]
        every = np.concatenate([every, bigrams(np.array(known.codes, np.uint64)[at], s)])
    ids, n = np.unique(np.array(every, np.int64), return_counts=True)
    return ids.astype(np.int32), (n / n.sum()).astype(np.float32)


@dataclass
class Model:
    settings: Settings
    vectors: np.ndarray
    layer: np.ndarray  # dim x 2

    def weights(self) -> np.ndarray:
        """What a bucket adds to the log odds of label 1."""
        return (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float64)


def train(labelled: Iterable[tuple[str | None, int]], s: Settings = Settings()) -> Model:  # noqa: B008
    """Learn from (text, label) pairs; without any, every text scores one half."""
    bags = [(bag(t, s), int(y)) for t, y in labelled]
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1 / s.dim, 1 / s.dim, (s.buckets, s.dim)).astype(np.float32)
    layer = np.zeros((s.dim, 2), np.float32)
    steps, done = max(1, s.epochs * len(bags)), 0
    for _ in range(s.epochs):
        for k in rng.permutation(len(bags)):
            (ids, share), label = bags[k]
            rate = s.rate * (1 - done / steps)
            done += 1
            own = vectors[ids]
            hidden = share @ own
            logit = hidden @ layer
            p = np.exp(logit - logit.max())
            grad = p / p.sum()
            grad[label] -= 1
            back = layer @ grad
            layer -= rate * np.outer(hidden, grad)
            # a document's buckets are distinct, so that plain assignment adds once;
            # steps are not divided by the document's length, or long ones would not teach
            own -= rate * np.minimum(1.0, share * 50)[:, None] * back
            vectors[ids] = own
    return Model(s, vectors, layer)


class Scorer:
    """Scores texts by the collapsed weights; what a word adds is remembered, in an older and a younger half."""

    def __init__(self, weights: np.ndarray, s: Settings) -> None:
        self.weights, self.settings = weights, s
        self.half = max(2, CACHE // 2)
        self.at: dict[str, int] = {}
        self.older: dict[str, int] = {}
        # a word's number is its place in the half that it is in
        self.young, self.old = (np.zeros((3, self.half)) for _ in range(2))

    def _learn(self, word: str) -> int:
        if len(self.at) == self.half:
            self.at, self.older = {}, self.at
            self.young, self.old = self.old, self.young
        k = self.at[word] = len(self.at)
        if (known := self.older.get(word)) is not None:
            self.young[:, k] = self.old[:, known]
        else:
            own = features(word, self.settings)
            self.young[:, k] = self.weights[own].sum(), len(own), crc32(word.encode("utf-8", "surrogatepass"))
        return k

    def _look(self, words: list[str]) -> np.ndarray:
        """Sum, number of features and code of each word."""
        out, start = [], 0
        while start < len(words):  # at most so many that none of them is forgotten meanwhile
            some = words[start : start + self.half]
            start += len(some)
            if len(self.at) + len(some) > self.half:
                missing = len({w for w in some if w not in self.at})
                if len(self.at) + missing > self.half:
                    self.at, self.older = {}, self.at
                    self.young, self.old = self.old, self.young
            known = self.at
            out.append(self.young[:, [known[w] if w in known else self._learn(w) for w in some]])
        return np.hstack(out) if out else np.zeros((3, 0))

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        out = []
        for text in texts:
            sums, counts, codes = self._look((text or "").split())
            pairs = self.weights[bigrams(codes.astype(np.uint64), self.settings)] if len(codes) > 1 else np.zeros(0)
            out.append((self.weights[0] + sums.sum() + pairs.sum()) / (1 + counts.sum() + len(pairs)))
        return 1 / (1 + np.exp(-np.clip(np.array(out, np.float64), -700, 700)))


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> list[tuple[str | None, int]]:  # noqa: B008
    """At most s.sample labelled texts outside the held-out fold, chosen by a hash of the id.

    Rows without id or label, and ids with both labels equally often, teach nothing; of an id
    whose texts differ the least one does. Texts of more than s.longest bytes don't teach, so that what the
    driver holds is bounded in rows and bytes (bags of features would be three times as large as texts).
    """
    small_batches(docs.sparkSession)
    votes = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("k").isNotNull())
    votes = votes.where(~held_out("k")).groupBy("k").agg(F.sum(F.col("y") * 2 - 1).alias("y")).where("y <> 0")
    chosen = votes.orderBy(F.xxhash64("k"), "k").limit(s.sample)
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where(F.coalesce(F.octet_length("t"), F.lit(0)) <= s.longest)
    rows = texts.join(F.broadcast(chosen), "k").groupBy("k", "y").agg(F.min("t").alias("t")).collect()
    return [(r.t, int(r.y > 0)) for r in sorted(rows, key=lambda r: r.k)]


def scored(spark, model: Model, text: Column) -> Column:  # noqa: ANN001
    """The probability of label 1 of a text: only texts go to Python, and only numbers come back."""
    small_batches(spark)
    s, shared = model.settings, spark.sparkContext.broadcast(model.weights())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value, s)
        for texts in batches:
            yield pa.array(scorer.scores(t.as_py() for t in texts), pa.float64())
        pa.default_memory_pool().release_unused()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")(text)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, held_out, score, predicted) for every row, and the columns named in keep.

    Only the text is scored. Null and empty texts score by the document's own vector
    (about the share of label 1); repeated rows score alike; an empty table gives no
    rows. One pass, no shuffle.
    """
    out = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), scored(docs.sparkSession, model, F.col(text_col)).alias("score"), *(F.col(c).alias(c) for c in keep))
    return out.select(id_col, "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *keep)


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of docs that score at least threshold, with all their columns, whatever these are called.

    Null and empty texts score by the document's own vector, repeated rows are kept or
    dropped alike, an empty table gives no rows. One pass, no shuffle; Python sees texts only.
    """
    return docs.where(scored(docs.sparkSession, model, F.col(text_col)) >= threshold)


def classify(docs: DataFrame, learn_from: DataFrame, labels: DataFrame, s: Settings = Settings(), **kw) -> DataFrame:  # noqa: B008
    """Train on learn_from and labels, score docs: a row for every row of docs, as score_documents gives them.

    Without any labelled row every score is one half.
    """
    return score_documents(docs, train(labelled_sample(learn_from, labels, s), s), **kw)
