"""Toxicity by a classifier chain (operator 9).

Each category has a linear (logistic) model over the terms of the whole text: its
distinct lower-cased words and their beginnings. A later model also sees the earlier
categories' probabilities; while training, those are out-of-fold predictions, so
that it learns from what earlier models say of texts they have not seen.

A labels table with one column (toxic) gives a chain of three: toxic texts with one of
the terms of abuse that are most spread (widespread), toxic texts with one of the others
(rare), which are different terms, and the label itself (toxic). Which terms those are
is learned for each fold from the other folds, so that no row's own label has a part in
the terms by which its categories are marked, and out-of-fold predictions hold none of it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .quality import held_out

CACHE = 1_000_000
#: Characters stripped from both ends of a word.
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "…“”‘’«»¿¡"


@dataclass(frozen=True)
class Settings:
    per_class: int = 1200  # labelled documents of each label that are learned from
    prefixes: tuple[int, ...] = (4, 5, 6)
    least: int = 4  # documents of the sample that a term must be in
    terms: int = 240  # terms that a model chooses
    folds: int = 5
    ridge: float = 1e-4
    longest: int = 1 << 16  # bytes of a text that is learned from, at most
    spread: float = 0.5  # share of the occurrences of abuse that the widespread terms make up
    threshold: float = 0.5


def terms_of(word: str, s: Settings) -> tuple[str, ...]:
    """The word in lower case without marks around it, and its beginnings (with a dash)."""
    w = word.lower().strip(EDGE)
    return (w, *(w[:n] + "-" for n in s.prefixes if len(w) >= n)) if w else ()


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Weights and intercept, by Newton's steps on the penalised likelihood."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    total = weight.sum()
    penalty = np.r_[np.full(x.shape[1], ridge * total), 1e-9]
    for _ in range(9):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        curve = np.maximum(p * (1 - p), 1e-6) * weight
        step = np.linalg.solve((a * curve[:, None]).T @ a + np.diag(penalty), a.T @ (weight * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-3:
            break
    return w[:-1], float(w[-1])


def words_of(text: str | list[str] | None) -> list[str]:
    return text if isinstance(text, list) else (text or "").split()


def folds_of(texts: list[str | list[str] | None], s: Settings) -> np.ndarray:
    """A fold for each text by its words; copies share one."""
    return np.array([crc32(" ".join(sorted(set(words_of(t)))).encode("utf-8", "surrogatepass")) % s.folds for t in texts], np.int64)


class Bags:
    """The sample's documents as sets of term numbers."""

    def __init__(self, texts: list[str | list[str] | None], s: Settings) -> None:
        known: dict[str, tuple[str, ...]] = {}
        sets = []
        for t in texts:
            own: set[str] = set()
            for w in set(words_of(t)):
                if w not in known:
                    known[w] = terms_of(w, s)
                own.update(known[w])
            sets.append(own)
        df = Counter(t for own in sets for t in own)
        self.names = sorted(t for t, n in df.items() if n >= s.least)
        at = {t: i for i, t in enumerate(self.names)}
        lists = [np.array(sorted(at[t] for t in own if t in at), np.int64) for own in sets]
        self.doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        self.term = np.concatenate(lists) if lists else np.zeros(0, np.int64)

    def choose(self, rows: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
        """The n terms that most raise the odds of y among the rows."""
        inside = rows[self.doc]
        doc, term = self.doc[inside], self.term[inside]
        pos = np.bincount(term[y[doc] == 1], minlength=len(self.names))
        neg = np.bincount(term[y[doc] == 0], minlength=len(self.names))
        a, b = (y[rows] == 1).sum(), (y[rows] == 0).sum()
        gain = (pos + 0.5) / (a + 1) - (neg + 0.5) / (b + 1)
        spread = np.sqrt((pos + neg + 1) / (a + b + 2) * (1 / (a + 1) + 1 / (b + 1)))
        z = gain / spread
        best = np.lexsort((np.arange(len(z)), -z))[:n]
        return best[z[best] > 2]

    def matrix(self, terms: np.ndarray, n_docs: int) -> np.ndarray:
        column = np.full(len(self.names) + 1, -1)
        column[terms] = np.arange(len(terms))
        to = column[self.term]
        out = np.zeros((n_docs, len(terms)))
        out[self.doc[to >= 0], to[to >= 0]] = 1
        return out


@dataclass
class Chain:
    settings: Settings
    categories: tuple[str, ...]
    #: term to its weight in each category's model
    weights: dict[str, tuple[float, ...]]
    #: of each category: intercept, and weights of the earlier categories' probabilities
    heads: tuple[tuple[float, ...], ...]

    def chances(self, total: Iterable[float]) -> list[float]:
        out: list[float] = []
        for z, (bias, *earlier) in zip(total, self.heads, strict=True):
            z += bias + sum(w * p for w, p in zip(earlier, out, strict=True))
            out.append(1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))
        return out


def train(texts: list[str | list[str] | None], labels: np.ndarray, weight: np.ndarray, categories: tuple[str, ...], s: Settings = Settings(), bags: Bags | None = None) -> Chain:  # noqa: B008
    """Learn a chain; labels has a column for each category, in the chain's order.

    A category without both labels in the sample gets a constant model.
    """
    n = len(texts)
    bags = bags or Bags(texts, s)
    fold = folds_of(texts, s)
    earlier = np.zeros((n, 0))
    weights: dict[str, list[float]] = {}
    heads = []

    def fit(rows: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        if len(set(y[rows])) < 2:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(earlier.shape[1]), 20.0 if rows.any() and y[rows][0] else -20.0
        chosen = bags.choose(rows, y, s.terms)
        x = np.hstack([bags.matrix(chosen, n), earlier])
        w, b = logistic(x[rows], y[rows], weight[rows], s.ridge)
        return chosen, w[: len(chosen)], w[len(chosen) :], b

    for k in range(len(categories)):
        y = labels[:, k]
        unseen = np.zeros(n)
        for f in range(s.folds):
            chosen, w, v, b = fit(fold != f, y)
            out = fold == f
            z = bags.matrix(chosen, n)[out] @ w + earlier[out] @ v + b
            unseen[out] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        chosen, w, v, b = fit(np.ones(n, bool), y)
        for t, x in zip(chosen, w, strict=True):
            weights.setdefault(bags.names[t], [0.0] * len(categories))[k] = float(x)
        heads.append((float(b), *map(float, v)))
        earlier = np.hstack([earlier, unseen[:, None]])
    return Chain(s, categories, {t: tuple(w) for t, w in weights.items()}, tuple(heads))


def abuse_labels(bags: Bags, toxic: np.ndarray, fold: np.ndarray, s: Settings) -> np.ndarray:
    """Columns widespread, rare, toxic: toxic rows by the kind of learned terms that they have.

    A row's terms are learned from the other folds. A term that begins with another learned beginning
    isn't counted besides it.
    """
    out = np.stack([np.zeros_like(toxic), np.zeros_like(toxic), toxic], 1)
    for f in range(s.folds):
        others, mine = fold != f, fold == f
        if not mine.any() or len(set(toxic[others])) < 2:
            continue
        chosen = bags.choose(others, toxic, s.terms)
        begun = {bags.names[t][:-1] for t in chosen if bags.names[t].endswith("-")}
        roots = np.array([t for t in chosen if not any(bags.names[t] != b + "-" and bags.names[t].startswith(b) for b in begun)], np.int64)
        hits = bags.matrix(roots, len(toxic))
        df = hits[others & (toxic == 1)].sum(0)
        order = np.lexsort((roots, -df))
        wide = np.zeros(len(roots), bool)
        wide[order] = np.cumsum(df[order]) - df[order] < s.spread * df.sum()
        for k, of in enumerate((wide, ~wide)):
            out[mine, k] = toxic[mine] * (hits[mine][:, of].sum(1) > 0)
    return out


class Scorer:
    """Scores whole texts; a word's terms are looked up once and kept in a bounded cache."""

    def __init__(self, chain: Chain) -> None:
        self.chain = chain
        self.cache: dict[str, tuple[str, ...]] = _Hits(chain)
        self.none = (0.0,) * len(chain.categories)

    def score(self, text: str | None) -> list[float]:
        hits = {t for found in map(self.cache.__getitem__, (text or "").split()) if found for t in found}
        weights = self.chain.weights
        return self.chain.chances([math.fsum(x) for x in zip(*(weights[t] for t in hits), strict=True)] if hits else self.none)


class _Hits(dict):
    def __init__(self, chain: Chain) -> None:
        self.chain, self.older = chain, {}

    def __missing__(self, word: str) -> tuple[str, ...]:
        if (found := self.older.get(word)) is None:
            known = self.chain.weights
            found = tuple(t for t in terms_of(word, self.chain.settings) if t in known)
        if len(self) >= CACHE // 2:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


def labelled_sample(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list[list[str]], np.ndarray, np.ndarray]:  # noqa: B008
    """(words, labels, weights): the distinct words of at most s.per_class texts of each label, chosen by a hash of the id.

    Only rows outside the held-out fold teach. An id marked both ways counts as toxic; of an
    id whose texts differ the least one teaches. Texts of more than s.longest bytes don't, so that what
    the driver holds is bounded in rows and bytes. Weights restore the share of each label.
    """
    small_batches(docs.sparkSession)
    marks = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("k").isNotNull())
    marks = marks.where(~held_out("k")).groupBy("k").agg(F.max("y").alias("y"))
    totals = {r.y: r.n for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for y in (0, 1):
        some = marks.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(s.per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where(F.coalesce(F.octet_length("t"), F.lit(0)) <= s.longest)
    texts = texts.join(F.broadcast(chosen), "k").groupBy("k", "y").agg(F.min("t").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [sorted(set((t.as_py() or "").split())) for t in b.column("t")]
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("y"), pa.array(own, pa.list_(pa.string()))], ["k", "y", "words"])

    rows = texts.mapInArrow(run, f"k {docs.schema[id_col].dataType.simpleString()}, y int, words array<string>").collect()
    rows.sort(key=lambda r: r.k)
    y = np.array([r.y for r in rows], np.int64)
    weight = np.array([totals[v] / max(1, (y == v).sum()) for v in y])
    return [list(r.words) for r in rows], y, weight / weight.mean() if len(y) else weight


def learn(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), **kw) -> Chain:  # noqa: B008
    """The chain widespread, rare, toxic from a table with the column toxic."""
    words, y, weight = labelled_sample(docs, labels, s, **kw)
    bags = Bags(words, s)
    return train(words, abuse_labels(bags, y, folds_of(words, s), s), weight, ("widespread", "rare", "toxic"), s, bags)


def score_documents(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, p_<category>..., predicted) for every row; predicted is by the chain's last category.

    Whole texts count. Null and empty texts have no terms and get the intercepts;
    repeated rows score alike; an empty table gives no rows. One pass, no shuffle.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    kind = docs.schema[id_col].dataType.simpleString()
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(shared.value).score
        for b in batches:
            got = [score(t.as_py()) for t in b.column(1)]
            cols = [pa.array([g[i] for g in got], pa.float64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["k", *names])

    narrow = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    out = narrow.mapInArrow(run, f"k {kind}, " + ", ".join(f"{n} double" for n in names))
    return out.select(F.col("k").alias(id_col), held_out("k").alias("held_out"), *names, (F.col(names[-1]) >= chain.settings.threshold).cast("int").alias("predicted"))
