"""LM scoring by a hashed maximum-entropy model (operator 12).

A token's probability is that of its class, of its slot in the class, and, for words that share
the last slot of their class, of the word among these. The first two are softmaxes over sums of
learned rows that the context's features hash to: the words one, two and three places before (the latter
two as skips) and the pair before. Words without a number of their own (seen once, or not among the most
frequent) are a class for themselves, with add-one probabilities, so that the model covers any text.

Words are counted over all training documents; each text becomes numbers once, in a written table, which all
later steps read. Classes come from the frequent words that a word stands beside, summed over the same
documents. Training goes over all of them in rounds: each task follows its own documents' gradients from the
shared weights, in sparse batches, and a tree of sums merges what the tasks have learned, row by row, weighted
by how often each had the row. The driver holds weights and the numbered vocabulary, both bounded by
the settings; other words' counts stay in a table and meet the texts' rare words in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, tree_sum, written
from .topk_search import learned_centres, nearest

END = b"\n"  # white space, so that no word is like it
MOST, NONE = 60.0, -80.0  # bounds of what goes into exp


@dataclass(frozen=True)
class Settings:
    words: int = 1 << 18  # most frequent words that get a number
    classes: int = 32  # the last one is for words without a number
    slots: int = 32  # the last one is for all other words of the class
    rows: int = 1 << 14  # of each table of weights, that features are hashed to
    near: int = 48  # most frequent words, whose company tells the classes
    learn: int = 4096  # words that the classes' centres are learned from
    rounds: int = 2
    batch: int = 1 << 14  # tokens of a gradient step
    rate: float = 0.25
    seed: int = 5


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-case A-Z, split at the six ASCII white spaces; null is empty."""
    return (text or b"").lower().split()


# Words and numbers


def _counted(batches: Iterator[pa.RecordBatch], most: int = 200_000) -> Iterator[pa.RecordBatch]:
    known: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(known), pa.binary()), pa.array(list(known.values()), pa.int64())], ["word", "n"])

    for b in batches:
        for text in b.column("text"):
            known.update(words_of(text.as_py()))
            if len(known) > most:
                yield out()
                known.clear()
        known[END] += b.num_rows
    yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over whole texts (text: binary), the end counted once for each; combined in the workers before the shuffle."""
    return docs.mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """Numbered words, the end first, then by falling count; rare is the number of all others, start that of what is before a text."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int  # N
    distinct: int  # V

    @property
    def rare(self) -> int:
        return len(self.words)

    @property
    def start(self) -> int:
        return len(self.words) + 1

    @property
    def rare_total(self) -> int:
        """Denominator of a rare word's probability among rare ones."""
        return self.tokens - int(self.counts.sum()) + self.distinct - int((self.counts > 0).sum()) + 1


def vocabulary(counts: DataFrame, s: Settings) -> Vocabulary:
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    end = counts.where(F.col("word") == F.lit(END)).first()
    top = counts.where((F.col("word") != F.lit(END)) & (F.col("n") > 1)).orderBy(F.col("n").desc(), "word").limit(s.words - 1).toArrow()
    return Vocabulary([END, *top.column("word").to_pylist()], np.array([end.n if end else 0, *top.column("n").to_pylist()], np.int64), n, v)


ENCODED = "row long, n_tokens long, n_rare long, n_known long, base double, ids binary, words array<binary>, times array<long>"


def encode(rows: DataFrame, known: Vocabulary) -> DataFrame:
    """ENCODED of rows (row, text, ...), with their further columns: the text's numbers (32 bits, little-endian, with the end), its rare words with their counts, and what
    the numbered ones add to log10 of the add-one probabilities and to the known tokens."""
    shared = rows.sparkSession.sparkContext.broadcast(known)
    others = [c for c in rows.columns if c not in ("row", "text")]
    kept = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        number = {w: i for i, w in enumerate(v.words)}.get
        logs, seen = np.append(np.log10(v.counts + 1.0), 0.0), np.append(v.counts > 0, False)
        each = np.log10(v.tokens + v.distinct + 1.0)
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for text in b.column("text"):
                words = words_of(text.as_py())
                words.append(END)
                ids = np.fromiter(map(number, words, repeat(v.rare)), np.int32, len(words))
                rare = np.flatnonzero(ids == v.rare)
                unlike = Counter(words[i] for i in rare.tolist())
                values = (len(ids), len(rare), int(seen[ids].sum()), float(logs[ids].sum() - len(ids) * each), ids.astype("<i4").tobytes(), list(unlike), list(unlike.values()))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column("row"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True)), *(b.column(c) for c in others)], [*(c.split()[0] for c in ENCODED.split(", ")), *others])

    return rows.mapInArrow(run, ENCODED + kept)


def joined(column: pa.Array, start: int) -> np.ndarray:
    """The texts' numbers one after the other, each after three starts."""
    gap = np.full(3, start, "<i4").tobytes()
    return np.frombuffer(b"".join(gap + t for t in column.to_pylist()), "<i4")


# Classes


def word_classes(encoded: DataFrame, known: Vocabulary, s: Settings) -> np.ndarray:
    """The class of each numbered word, by the most frequent words that stand before and after it anywhere in the training texts."""
    near, start = min(s.near, known.rare), known.start

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate([*held, np.zeros(0, np.int64)]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(key // near), pa.array((key % near).astype(np.int32)), pa.array(n)], ["word", "by", "n"])

        for b in batches:
            x = joined(b.column("ids"), start).astype(np.int64)
            for word, by in ((x[1:], x[:-1]), (x[:-1], x[1:])):
                fit = (by < near) & (word < known.rare)
                held.append(word[fit] * near + by[fit])
            if sum(map(len, held)) > 4_000_000:
                yield out()
        yield out()

    sums = encoded.select("ids").mapInArrow(pairs, "word long, by int, n long").groupBy("word", "by").agg(F.sum("n").alias("n"))
    company = written(sums.groupBy("word").agg(F.collect_list(F.struct("by", "n")).alias("c")), "lm-company")  # s.near entries at most

    def profiles(lists: list[list[dict]]) -> np.ndarray:
        x = np.zeros((len(lists), near))
        for i, c in enumerate(lists):
            for e in c:
                x[i, e["by"]] = e["n"]
        x = np.sqrt(x)
        return x / np.maximum(1e-12, np.sqrt((x * x).sum(1)))[:, None]

    first = company.where(F.col("word") < s.learn).orderBy("word").toArrow()
    centres = learned_centres(profiles(first.column("c").to_pylist()), s.classes - 1, s.seed)
    shared = encoded.sparkSession.sparkContext.broadcast(centres)

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("word"), pa.array(nearest(profiles(b.column("c").to_pylist()), shared.value)[0].astype(np.int32))], ["word", "class"])

    got = company.mapInArrow(classed, "word long, class int").toArrow()  # a row per numbered word
    out = np.zeros(known.rare, np.int64)
    out[got.column("word").to_numpy()] = got.column("class").to_numpy()
    return out


@dataclass
class Layout:
    """Where each number is (rare words last), and which classes and slots there are."""

    classes: np.ndarray
    slots: np.ndarray
    tail: np.ndarray  # log probability within the last slot
    class_bias: np.ndarray  # log shares; NONE where there is no word
    slot_bias: np.ndarray


def layout(known: Vocabulary, classes: np.ndarray, s: Settings) -> Layout:
    of = np.append(classes, s.classes - 1)
    slots, tail = np.full(len(of), s.slots - 1), np.zeros(len(of))
    counts = np.append(known.counts, known.tokens - known.counts.sum()).astype(np.float64)
    for c in range(s.classes - 1):
        own = np.flatnonzero(of[:-1] == c)
        own = own[np.argsort(-counts[own], kind="stable")]
        told = own[: s.slots - 1]
        slots[told] = np.arange(len(told))
        rest = own[s.slots - 1 :]
        tail[rest] = np.log(np.maximum(counts[rest], 0.5) / np.maximum(counts[rest], 0.5).sum())
    mass = np.zeros((s.classes, s.slots))
    np.add.at(mass, (of, slots), np.maximum(counts, 0.5))  # what wasn't seen stays possible
    share = lambda x, of: np.where(x > 0, np.log(np.where(x > 0, x, 1.0) / np.maximum(of, 1e-300)), NONE).astype(np.float32)
    return Layout(of, slots, tail, share(mass.sum(1), mass.sum()), share(mass, mass.sum(1, keepdims=True)))


# Weights


@dataclass
class Weights:
    """Rows of both softmaxes; the first one's last row and the second one's last rows, by class, belong to every context."""

    classes: np.ndarray
    slots: np.ndarray
    energy: tuple[np.ndarray, np.ndarray]  # squares of each row's gradients so far

    @staticmethod
    def first(at: Layout, s: Settings) -> Weights:
        a = np.vstack([np.zeros((s.rows, s.classes), np.float32), at.class_bias[None, :]])
        b = np.vstack([np.zeros((s.rows, s.slots), np.float32), at.slot_bias])
        return Weights(a, b, (np.zeros(len(a), np.float32), np.zeros(len(b), np.float32)))


def _rows(kind: int, s: Settings, *parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[0]), kind, np.uint64)
    for p in parts:
        h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ p.astype(np.uint64)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return (h % np.uint64(s.rows) if s.rows & (s.rows - 1) else h & np.uint64(s.rows - 1)).astype(np.int32)


def features(x: np.ndarray, at: Layout, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(numbers, classes, slots, rows of the class features, rows of the slot features) of joined numbers, without the starts."""
    token = np.flatnonzero(x < len(at.classes))
    own, one, two, three = (x[token - k] for k in range(4))
    c, slot = at.classes[own], at.slots[own]
    of_class = [_rows(1, s, one), _rows(2, s, two), _rows(3, s, three), _rows(4, s, one, two)]
    of_slot = [_rows(5, s, c, one), _rows(6, s, c, one, two), (s.rows + c).astype(np.int32)]
    return own, c, slot, of_class, of_slot


def _softmax(table: np.ndarray, rows: list[np.ndarray], always: np.ndarray | None, target: np.ndarray, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(probabilities, or what is in proportion to them if not whole; log probability of the target). always: a row of every context."""
    z = np.take(table, rows[0], axis=0)
    more = np.empty_like(z)
    for r in rows[1:]:
        z += np.take(table, r, axis=0, out=more, mode="clip")
    if always is not None:
        z += always
    np.minimum(z, MOST, out=z)  # far beyond what is learned, but exp must not overflow
    own = z[np.arange(len(z)), target]
    np.exp(z, out=z)
    total = z @ np.ones(z.shape[1], z.dtype)
    if whole:
        z /= total[:, None]
    return z, own - np.log(total)


def log_probabilities(x: np.ndarray, w: Weights, at: Layout, s: Settings) -> np.ndarray:
    """Of each token of joined numbers; of rare ones, that of their class."""
    own, c, slot, of_class, of_slot = features(x, at, s)
    out = at.tail[own]
    for i in range(0, len(own), s.batch):
        part = slice(i, i + s.batch)
        out[part] += _softmax(w.classes, [f[part] for f in of_class], w.classes[s.rows], c[part], False)[1]
        out[part] += _softmax(w.slots, [f[part] for f in of_slot], None, slot[part], False)[1]
    return out


#: Uses of a row in a batch that are added for all rows together; those of rows that have more are summed row by row.
TOGETHER = 8


def _summed(gradient: np.ndarray, order: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each run of order (starts, size; the longest first) the sum of its rows of gradient."""
    total = np.take(gradient, order[starts], axis=0)
    for j in range(1, TOGETHER):
        n = np.count_nonzero(size > j)
        if not n:
            break
        total[:n] += np.take(gradient, order[starts[:n] + j], axis=0)
    ones = np.ones(size[0] if len(size) else 0, gradient.dtype)
    for i in range(np.count_nonzero(size > TOGETHER)):
        rest = order[starts[i] + TOGETHER : starts[i] + size[i]]
        total[i] += ones[: len(rest)] @ np.take(gradient, rest, axis=0)
    return total


def _step(table: np.ndarray, energy: np.ndarray, used: np.ndarray, rows: list[np.ndarray], gradient: np.ndarray, s: Settings) -> None:
    """Move the rows against their summed gradients, less the more they have moved already."""
    for r in rows:
        order = np.argsort(r.astype(np.uint16) if len(table) <= 1 << 16 else r, kind="stable")  # 16 bits are sorted by radix
        at = r[order]
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        size = np.diff(np.append(starts, len(at)))
        longest = np.argsort(-size, kind="stable")
        starts, size = starts[longest], size[longest]
        total = _summed(gradient, order, starts, size)
        own = at[starts]
        used[own] += size
        energy[own] += np.einsum("ij,ij->i", total, total)
        total *= (s.rate / np.sqrt(1.0 + energy[own]))[:, None]
        table[own] -= total


def follow(batches: Iterator[np.ndarray], w: Weights, at: Layout, s: Settings) -> np.ndarray:
    """One task's part of a round: for each row how often it was used, its change times that, and the squares of its gradients."""
    classes, slots, energy = w.classes.copy(), w.slots.copy(), tuple(e.copy() for e in w.energy)
    used = [np.zeros(len(e), np.float32) for e in energy]
    for x in batches:
        own, c, slot, of_class, of_slot = features(x, at, s)
        for i in range(0, len(own), s.batch):
            part = slice(i, i + s.batch)
            n = len(own[part])
            every = np.arange(n)
            rows = [f[part] for f in of_class]
            p, _ = _softmax(classes, rows, classes[s.rows], c[part])
            p[every, c[part]] -= 1
            _step(classes, energy[0], used[0], rows, p, s)
            total = p.sum(0)
            used[0][s.rows] += n
            energy[0][s.rows] += total @ total
            classes[s.rows] -= s.rate * total / np.sqrt(1.0 + energy[0][s.rows])
            rows = [f[part] for f in of_slot]
            p, _ = _softmax(slots, rows, None, slot[part])
            p[every, slot[part]] -= 1
            _step(slots, energy[1], used[1], rows, p, s)
    parts = [used[0], (classes - w.classes) * used[0][:, None], energy[0] - w.energy[0], used[1], (slots - w.slots) * used[1][:, None], energy[1] - w.energy[1]]
    return np.concatenate([p.ravel() for p in parts]).astype(np.float32)


def merged(w: Weights, sums: np.ndarray) -> Weights:
    """The weights after a round, from the sum of the tasks' parts."""
    out, at = [], 0
    for table, energy in ((w.classes, w.energy[0]), (w.slots, w.energy[1])):
        n, size = len(table), table.size
        used, change, more = sums[at : at + n], sums[at + n : at + n + size].reshape(table.shape), sums[at + n + size : at + 2 * n + size]
        out.append((table + change / np.maximum(1.0, used)[:, None], energy + more))
        at += 2 * n + size
    return Weights(out[0][0].astype(np.float32), out[1][0].astype(np.float32), (out[0][1].astype(np.float32), out[1][1].astype(np.float32)))


def train(encoded: DataFrame, known: Vocabulary, at: Layout, s: Settings) -> Weights:
    """Weights from all rows of encoded (row, ids): each teaches in one of the rounds."""
    w = Weights.first(at, s)
    for k in range(s.rounds):
        shared = encoded.sparkSession.sparkContext.broadcast((w, at))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            weights, places = shared.value
            texts = (joined(b.column("ids"), known.start) for b in batches if b.num_rows)
            first = next(texts, None)
            if first is not None:

                def every() -> Iterator[np.ndarray]:
                    yield first
                    yield from texts

                yield pa.RecordBatch.from_arrays([pa.array([follow(every(), weights, places, s).tobytes()], pa.binary())], ["m"])

        part = encoded.where(F.pmod(F.xxhash64("row", F.lit(s.seed)), F.lit(s.rounds)) == k).select("ids")
        sums = tree_sum(part.mapInArrow(run, "m binary"), "m", np.float32)
        w = w if sums is None else merged(w, sums)
        shared.unpersist()
    return w


# Scores


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo by; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % by


def scored(encoded: DataFrame, w: Weights, at: Layout, known: Vocabulary, s: Settings) -> DataFrame:
    """(row, log): log10 probability of each text; rare words count as their class."""
    shared = encoded.sparkSession.sparkContext.broadcast((w, at))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, places = shared.value
        for b in batches:
            if b.num_rows:
                each = log_probabilities(joined(b.column("ids"), known.start), weights, places, s)
                sizes = np.array([len(t) // 4 for t in b.column("ids").to_pylist()])  # one at least: every text has its end
                total = np.add.reduceat(each, np.cumsum(sizes) - sizes) / np.log(10)
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(total)], ["row", "log"])

    return encoded.select("row", "ids").mapInArrow(run, "row long, log double")


def score_documents(docs: DataFrame, s: Settings = Settings(), folds: int = 7, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:  # noqa: B008
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Rows whose id's remainder is held don't teach, nor do rows without id (held_out is false for these). Null and empty texts are
    the end alone; repeated rows teach and are scored each; very long texts are whole, in batches. A table without training rows scores
    by counts of zero; an empty table gives no rows. Other columns aren't looked at.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), remainder(id_col, folds).alias("k"), F.col(text_col).cast("binary").alias("text"))
    teaches = F.coalesce(F.col("k") != held, F.lit(False))
    counts = written(word_counts(texts.where(teaches).select("text")), "lm-counts")
    known = vocabulary(counts, s)
    numbered = texts.select(F.monotonically_increasing_id().alias("row"), "id", F.coalesce(F.col("k") == held, F.lit(False)).alias("held_out"), teaches.alias("teaches"), "text")
    encoded = written(encode(numbered, known), "lm-encoded")
    lessons = encoded.where("teaches")
    at = layout(known, word_classes(lessons, known, s), s)
    w = train(lessons, known, at, s)
    rare = encoded.where("n_rare > 0").select("row", F.explode(F.arrays_zip("words", "times")).alias("e")).select("row", "e.words", "e.times").withColumnRenamed("words", "word")
    rare = rare.join(counts, "word", "left").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rare_log"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    out = encoded.select("row", "id", "held_out", "n_tokens", "n_rare", "n_known", "base").join(scored(encoded, w, at, known, s), "row").join(rare, "row", "left")
    log, each = F.coalesce("rare_log", F.lit(0.0)), float(np.log10(known.rare_total))
    return out.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + log).alias("base_score"),
        (F.col("log") + log - F.col("n_rare") * each).alias("score"),
    )

