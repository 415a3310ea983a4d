"""Similarity join on word shingles with adaptive multi-match prefixes (operator 7).

Two documents whose sets have Jaccard similarity t or more share at least l of the
first |x| - ceil(t |x|) + l elements of either set, in any order common to all sets.
The order is by a hash, but shingles that several documents of a sample have go last,
and so do those that are found to bring too many documents together, so that prefixes
hold rare ones. A document's l grows with the candidates that
its prefix would bring: a longer prefix, but as many shared elements before a pair
is verified.

Exact copies are one class from the start. To keep the work linear inside large
groups of near copies, links are found in two steps:

1. Every document is verified against one that shares one of its smallest hashes
   (a star for each of them, not all pairs), and then, as long as prefix elements
   bring too many components together, against one that shares many of those elements
   and has many that are widespread: in a group of edited copies the least edited one,
   which links with nearly all. Verified links are merged into components.
2. A document that has too few elements in common with all members of a large
   component together can't link with any of them, and isn't compared with them.
3. Prefixes of all documents are joined, but an element that only one component has
   is left out, and only pairs from different components and of sizes that are near
   enough are counted and verified. No link between components that step 1 left apart
   can be missed.

All verifications are exact: whole sets are intersected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, components, runs, scratch, small_batches, unused, written

#: Bytes that separate words.
SPACES = (9, 10, 11, 12, 13, 32)


@dataclass(frozen=True)
class Settings:
    percent: int = 75
    words: int = 5
    longest: int = 4  # largest l
    firsts: int = 3  # smallest hashes of a set whose stars step 1 follows
    sample: int = 10_000  # documents in which common shingles are looked for
    common: int = 200_000  # common shingles that go last, at most
    large: int = 8  # documents of a component that meet in an element from which others are compared with all of them at once
    rounds: int = 3  # times that prefixes may be made anew
    leaders: int = 400  # documents whose elements all go last, at a time
    crowd: int = 6  # documents that may share an element, if meetings are too many
    meetings: int = 1  # pairs of documents of different components meeting in crowded elements, for each document
    cost: int = 64  # meetings from which a document's prefix is lengthened
    verify: float = 2.0  # cost of verifying a candidate, in meetings
    block: int = 1 << 18  # elements of a cluster's sets (2 MB) that are held in one place, unless one set has more
    broadcast: int = 600_000  # rows of ids that may be broadcast
    elements: int = 1_500_000  # elements that may be broadcast


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sets of shingle hashes of whole texts, computed on bytes with numpy.

    A word's hash is the sum of random values of its bytes times powers of an odd
    number, taken from running sums over all texts of a batch; a shingle's hash
    combines those of its words in order.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, words: int) -> None:
        rng = np.random.default_rng(20)
        self.words = words
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for upper in range(65, 91):
            self.values[upper] = self.values[upper + 32]
        self.space = np.zeros(256, bool)
        self.space[list(SPACES)] = True
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = n + n // 4
            inverse = pow(self.BASE, -1, 1 << 64)
            for name, base in (("up", self.BASE), ("down", inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """For each text its distinct shingle hashes, ascending."""
        joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        up, down = self.powers(len(joined) + 1)
        space = self.space[joined]
        edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
        begin = np.flatnonzero(edge == -1)
        end = np.flatnonzero(edge == 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values[joined] * up[: len(joined)], dtype=np.uint64)])
        word = mixed((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
        last = np.cumsum([len(t) + 1 for t in texts])
        first = np.searchsorted(begin, last - [len(t) + 1 for t in texts])
        stop = np.searchsorted(begin, last)
        k = self.words
        shingle = np.zeros(max(0, len(word) - k + 1), np.uint64)
        for i in range(k):
            shingle = shingle * np.uint64(self.BASE) + word[i : len(word) - k + 1 + i] if len(shingle) else shingle
        shingle = mixed(shingle)
        out = []
        for a, b in zip(first.tolist(), stop.tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(shingle[a : b - k + 1]))
            elif b > a:
                h = np.uint64(b - a)
                for w in word[a:b]:
                    h = mixed(np.array([h * np.uint64(self.BASE & 0xFFFFFFFF) ^ w]))[0]
                out.append(np.array([h], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def shingled(texts: pa.Array, s: Shingler, size: int = 1 << 18) -> Iterator[np.ndarray]:
    """The sets of a column of texts, a quarter of a megabyte at a time; null texts have empty sets."""
    part, held = [], 0
    with np.errstate(over="ignore"):
        for t in texts.cast(pa.binary()).to_pylist():
            part.append(t or b"")
            held += len(part[-1])
            if held >= size:
                yield from s.sets(part)
                part, held = [], 0
        if part:
            yield from s.sets(part)
    pa.default_memory_pool().release_unused()


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that few sets are held at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def needed(n: int, percent: int) -> int:
    """The least intersection with which a set of n elements can be similar enough."""
    return -(-percent * n // 100)


def signatures(docs: DataFrame, common: np.ndarray | None, s: Settings) -> DataFrame:
    """(id, n, digest, shared, least, prefix) of (id, t): set size, a digest of the set, how many elements are common ones, its smallest hashes, and the elements of its longest prefix in order."""
    kind = docs.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(common) if common is not None and len(common) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(s.words)
        late = shared.value if shared else None
        for b in sliced(batches):
            n, digest, known, prefix, least = [], [], [], [], []
            for own in shingled(b.column("t"), shingler):
                size = len(own)
                n.append(size)
                with np.errstate(over="ignore"):
                    a, c = int(own.sum(dtype=np.uint64)), int(mixed(own ^ np.uint64(Shingler.BASE)).sum(dtype=np.uint64))
                digest.append(f"{size:x}.{a:x}.{c:x}")
                least.append(own[: s.firsts].view(np.int64))
                keep = size - needed(size, s.percent) + s.longest
                common = 0
                if late is not None and size:
                    last = late[np.minimum(np.searchsorted(late, own), len(late) - 1)] == own
                    common = int(last.sum())
                    own = np.concatenate([own[~last], own[last]])
                known.append(common)
                prefix.append(own[: min(keep, size)].view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int32()), pa.array(digest, pa.string()), pa.array(known, pa.int32()), lists(least), lists(prefix)], ["id", "n", "digest", "shared", "least", "prefix"])

    return docs.mapInArrow(run, f"id {kind}, n int, digest string, shared int, least array<long>, prefix array<long>")


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """Arrays of 64-bit values as a column of lists."""
    ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32))
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)))


def common_shingles(docs: DataFrame, n_docs: int, s: Settings) -> np.ndarray:
    """Shingles that several of a sample of documents have, ascending: at most s.common, the most frequent.

    They only change the order of prefixes, so that what the sample misses costs time but no link.
    Hashes in the upper part come late in any case and aren't counted.
    """
    share = min(1.0, s.sample / max(1, n_docs))
    chosen = docs.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1_000_000)) < int(share * 1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(s.words)
        for b in batches:
            sets = list(shingled(b.column("t"), shingler))
            if sets:
                # copies would make every one of their shingles common
                sets = list({x.tobytes(): x for x in sets}.values())
                every = np.concatenate(sets)
                values, n = np.unique(every[every < np.uint64(0.4 * 2**64)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    counted = chosen.select("t").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n >= 3")
    return hashes(counted.orderBy(F.col("n").desc(), "h").limit(s.common))


def verified(pairs: DataFrame, docs: DataFrame, sizes: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough; sizes: (id, n) of all sets.

    Documents that are joined by pairs, over any number of steps, form a cluster and meet
    in one place, so that a set travels once rather than with each of its pairs. A cluster
    of more than s.block elements is cut into blocks, and a set goes to each block
    that it has a pair in. Sets are computed again from the texts of these documents alone.
    """
    if pairs.isEmpty():
        return pairs
    kind = docs.schema["id"].dataType.simpleString()
    clusters = written(components(pairs, "join-cluster"), "join-clusters")
    weights = sizes.join(bounded(clusters.withColumnRenamed("node", "id"), s.broadcast), "id")
    sizes = weights.groupBy("root").agg(F.ceil(F.sum("n") / s.block).cast("int").alias("cuts"))
    placed = written(clusters.join(sizes, "root").select(F.col("node").alias("id"), "root", F.pmod(F.xxhash64("node"), "cuts").cast("int").alias("cut")), "join-placed")
    at = bounded(placed, s.broadcast)
    located = pairs.join(at.select(F.col("id").alias("a"), "root", F.col("cut").alias("i")), "a").join(at.select(F.col("id").alias("b"), F.col("cut").alias("j")), "b")
    located = written(located, "join-located")
    group = ["root", "i", "j"]
    wanted = located.select(F.col("a").alias("id"), *group).unionByName(located.select(F.col("b").alias("id"), *group)).distinct()
    wanted = written(wanted, "join-wanted")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(s.words)
        for b in sliced(batches):
            yield pa.RecordBatch.from_arrays([b.column("id"), lists(list(shingled(b.column("t"), shingler)))], ["id", "s"])

    texts = docs.join(bounded(placed.select("id"), s.broadcast), "id", "left_semi")
    sets = texts.mapInArrow(to_sets, f"id {kind}, s array<long>").join(bounded(wanted, s.broadcast // 2), "id")
    none = F.lit(None)
    rows = sets.select(*group, "id", none.cast(kind).alias("b"), "s").unionByName(located.select(*group, F.col("a").alias("id"), "b", none.cast("array<long>").alias("s")))
    dealt = rows.repartition(*group).sortWithinPartitions(*group, F.col("b").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in runs(batches, group):
            ids, partners = t.column("id").to_pylist(), t.column("b").to_pylist()
            column = t.column("s").combine_chunks()
            values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            n = sum(p is None for p in partners)
            of: dict = {}
            for k in range(n):  # an id whose rows differ has several sets
                of.setdefault(ids[k], []).append(values[ends[k] : ends[k + 1]].view(np.uint64))
            found = [(a, b) for a, b in zip(ids[n:], partners[n:], strict=True) if any(alike(x, y, s.percent) for x in of.get(a, ()) for y in of.get(b, ()))]
            types = t.schema.field("id").type
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], types), pa.array([b for _, b in found], types)], ["a", "b"])

    return dealt.mapInArrow(compare, f"a {kind}, b {kind}")


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets are similar enough."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or 100 * len(x) < percent * len(y):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    same = int((y[at] == x).sum())
    return 100 * same >= percent * (len(x) + len(y) - same)


def _entries(reps: DataFrame) -> DataFrame:
    """(id, digest, n, h, at): the elements of every prefix with their places."""
    return reps.select("id", "digest", "n", F.posexplode("prefix").alias("at", "h"))


def rooted(rows: DataFrame, moved: DataFrame, s: Settings) -> DataFrame:
    """rows with the root of their id's component: its own id unless it has moved."""
    return rows.join(bounded(moved, s.broadcast), "id", "left").withColumn("root", F.coalesce("root", "id"))


def tops(crowd: DataFrame, moved: DataFrame, s: Settings) -> DataFrame:
    """(h, top, most, df, met): of each element of crowd (h, id) that different components have, the component with most of its documents, and the pairs across."""
    own = rooted(crowd, moved, s).groupBy("h", "root").agg(F.count("*").alias("k"))
    met = own.groupBy("h").agg(F.max_by("root", "k").alias("top"), F.max("k").alias("most"), F.sum("k").alias("df"), F.sum(F.col("k") * F.col("k")).alias("same"))
    return met.select("h", "top", "most", "df", ((F.col("df") * F.col("df") - F.col("same")) / 2).alias("met")).where("met > 0")


def laned(rows: DataFrame, top: DataFrame, bars: DataFrame, s: Settings) -> DataFrame:
    """rows (h, id, root) with their lane in a crowded element: 0 of its largest component, 2 barred from that one, else 1; null elsewhere."""
    seen = rows.join(bounded(top.select("h", "top"), s.elements // 2), "h", "left").join(bounded(bars, s.broadcast // 4), "id", "left")
    barred = F.coalesce(F.array_contains("bars", F.col("top")), F.lit(False))
    lane = F.when(F.col("top").isNotNull(), F.when(F.col("root") == F.col("top"), 0).when(barred, 2).otherwise(1))
    return seen.withColumn("lane", lane).drop("top", "bars")


def left_over(crowd: DataFrame, moved: DataFrame, top: DataFrame, bars: DataFrame, s: Settings) -> DataFrame:
    """(h, df, met): the pairs across components that meet in the elements of top (h, top, most, df, met) and aren't barred."""
    barred = laned(rooted(crowd, moved, s), top, bars, s).where("lane = 2").groupBy("h").agg(F.count("*").alias("barred"))
    met = top.join(bounded(barred, s.elements // 2), "h", "left").select("h", "df", (F.col("met") - F.col("most") * F.coalesce("barred", F.lit(0))).alias("met"))
    return met.where("met > 0")


def barred_from(crowd: DataFrame, moved: DataFrame, top: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """(id, bars): components, out of those that are largest in one of its crowded elements, that hold nothing the document can link with.

    What it has in common with any member is at most what it has in common with all of them together.
    An id whose texts differ counts with the elements of all of them and the size of the smallest.
    """
    kind = docs.schema["id"].dataType.simpleString()
    large = bounded(top.where(F.col("most") >= s.large).select("h", F.col("top").alias("bar")), s.elements // 2)
    rows = rooted(crowd.join(large, "h"), moved, s)
    asked = written(rows.where("root <> bar").groupBy("id", "bar").agg(F.min("n").alias("n")), "join-asked")
    bar = written(asked.select("bar").distinct(), "join-bars")
    members = written(moved.select("id", F.col("root").alias("bar")).unionByName(bar.select(F.col("bar").alias("id"), "bar")).join(bounded(bar, s.broadcast), "bar", "left_semi").distinct(), "join-members")

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(s.words)
        for b in sliced(batches):
            of: dict = {}
            for r, own in zip(b.column("bar").to_pylist(), shingled(b.column("t"), shingler), strict=True):
                held = of.setdefault(r, [None, []])
                held[0] = len(own) if held[0] is None else min(held[0], len(own))
                held[1].append(own)
            for r, (n, sets) in of.items():
                every = np.unique(np.concatenate(sets)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([r] * len(every), b.schema.field("bar").type), pa.array(every), pa.array(np.full(len(every), n, np.int32))], ["bar", "h", "n"])

    texts = docs.join(bounded(members, s.broadcast), "id").select("bar", "t")
    union = written(texts.mapInArrow(united, f"bar {kind}, h long, n int").groupBy("bar", "h").agg(F.min("n").alias("n")), "join-union")
    smallest = union.groupBy("bar").agg(F.min("n").alias("m"))

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(s.words)
        for b in sliced(batches, 100):
            sets = list(shingled(b.column("t"), shingler))
            ids = b.column("id").take(pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in sets])))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64))], ["id", "h"])

    own = docs.join(bounded(asked.select("id").distinct(), s.broadcast), "id", "left_semi").mapInArrow(exploded, f"id {kind}, h long")
    both = own.join(bounded(asked, s.broadcast), "id").join(bounded(union.select("bar", "h"), s.elements), ["bar", "h"])
    common = written(both.groupBy("id", "bar").agg(F.count("*").alias("common")), "join-common")
    judged = asked.join(bounded(common, s.broadcast), ["id", "bar"], "left").join(bounded(smallest, s.broadcast), "bar")
    # the smallest member that is large enough needs least in common
    other = F.greatest("m", F.expr(f"cast((n * {s.percent}L + 99) div 100 as int)"))
    need = F.floor(((F.col("n") + other) * s.percent + 99 + s.percent) / (100 + s.percent))
    barred = judged.where(F.coalesce("common", F.lit(0)) < need)
    return written(barred.groupBy("id").agg(F.collect_set("bar").alias("bars")), "join-barred")


def hubs(crowd: DataFrame, moved: DataFrame, met: DataFrame, s: Settings) -> DataFrame:
    """(a, b): for each document of crowd (h, id, n) a document of another component to be verified with, one at most.

    An element's hub is the document with most crowded elements among those that have it. A document goes to the
    hub that most of its elements have.
    """
    rows = crowd.join(bounded(met.select("h"), s.elements), "h")
    fame = rows.groupBy("id").agg(F.count("*").alias("fame"))
    rank = fame.select("id", (F.shiftleft("fame", 20) + F.pmod(F.xxhash64("id"), F.lit(1 << 20))).alias("rank"))
    rows = written(rooted(rows.join(bounded(rank, s.broadcast), "id"), moved, s), "join-crowd")
    hub = rows.groupBy("h").agg(F.max_by("id", "rank").alias("c"), F.max_by("n", "rank").alias("m"), F.max_by("root", "rank").alias("centre"))
    near = F.least("n", "m") * 100 >= F.greatest("n", "m") * s.percent
    meets = rows.join(bounded(hub, s.elements // 2), "h").where((F.col("root") != F.col("centre")) & near)
    best = meets.groupBy("id", "c").agg(F.count("*").alias("k")).groupBy("id").agg(F.max_by("c", "k").alias("b"))
    return best.select(F.col("id").alias("a"), "b")


def elements(docs: DataFrame, ids: DataFrame, s: Settings) -> DataFrame:
    """(h): all elements of a bounded number of documents, s.common at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(s.words)
        for b in sliced(batches):
            for own in shingled(b.column("t"), shingler):
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], ["h"])

    return docs.join(F.broadcast(ids), "id", "left_semi").select("t").mapInArrow(run, "h long").distinct().limit(s.common)


def hashes(rows: DataFrame) -> np.ndarray:
    """A bounded column of hashes, ascending."""
    return np.sort(rows.select("h").toArrow().column("h").to_numpy().view(np.uint64))


def often(met: DataFrame) -> DataFrame:
    """(id1, id2) of the meetings (id1, id2, need) that are as many as the least of their needs: an id's texts may need more or fewer."""
    return met.groupBy("id1", "id2").agg(F.count("*").alias("k"), F.min("need").alias("need")).where("k >= need")


def groups(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:  # noqa: B008
    """(id, n_shingles, component_id) for every row.

    A-Z are lower-cased; words are runs without white space; a set holds the distinct
    shingles, or all words as one where there are fewer; texts that are null, empty
    or white space have empty sets and link with nothing, as do rows without id.
    Rows with the same id are one document; where their texts differ, it links with
    what any of them links with. An empty table gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    with scratch(docs.sparkSession):
        return _groups(docs, s, id_col, text_col)


def _groups(docs: DataFrame, s: Settings, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    known = docs.where("id is not null and t is not null")
    total, ids = known.agg(F.count("*"), F.approx_count_distinct("id", 0.01)).first()
    once = ids >= 0.9 * total and known.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    if not once:  # texts are only shuffled where ids repeat
        known = written(known.distinct(), "join-distinct")
    late = common_shingles(known, total, s)
    sigs = written(signatures(docs, late, s), "join-signatures", keep=True)

    # Exact copies: one representative for each digest; also rows that share an id.
    usable = sigs.where("n > 0 and id is not null")
    usable = usable if once else usable.dropDuplicates(["id", "digest"])
    row = ["id"] if once else ["id", "digest"]  # what names a text
    classes = usable.groupBy("digest").agg(F.min("id").alias("rep"), F.max("id").alias("top"))
    several = written(classes.where("rep <> top").select("digest", "rep"), "join-classes")
    several = bounded(several, s.broadcast // 8)
    copies = written(usable.select("id", "digest").join(several, "digest").where("id <> rep"), "join-copies")
    reps = usable.join(bounded(copies.select(*row), s.broadcast), row, "left_anti")

    sizes = reps.select("id", "n")

    # Step 1: stars around one document of each of the smallest hashes (similar sets mostly share
    # them, whereas the rare elements that prefixes begin with are those that copies don't share): the one
    # with the largest share of common elements, which copies were least edited to get.
    rank = F.shiftleft((F.col("shared") / F.col("n") * 1000).cast("long"), 40) + F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    first = reps.select("id", "n", rank.alias("rank"), F.explode("least").alias("h"))
    centre = first.groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("top"), F.max_by("id", "rank").alias("c"), F.max_by("n", "rank").alias("m"))
    centre = written(centre.where("low <> top").select("h", "c", "m"), "join-centres")
    stars = first.join(bounded(centre, s.elements // 2), "h").where("id <> c").where(F.least("n", "m") * 100 >= F.greatest("n", "m") * s.percent)
    stars = written(stars.select(F.col("id").alias("a"), F.col("c").alias("b")).distinct(), "join-stars")
    linked = written(verified(stars, known, sizes, s), "join-linked")

    def merged(links: DataFrame) -> DataFrame:
        """(id, root) of the documents that have a smaller one in their component."""
        return written(components(links, "join-cc1").where("node <> root").select(F.col("node").alias("id"), "root"), "join-moved")

    moved = merged(linked)

    # Step 2: prefixes, an element at a time, where several components have it.
    entries = _entries(reps)

    def in_several(e: DataFrame) -> DataFrame:
        own = rooted(e, moved, s).groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("df"))
        return written(own.where("low <> high").select("h", "df"), "join-shared")

    shared = in_several(entries)
    bars = known.sparkSession.createDataFrame([], f"id {kind}, bars array<{kind}>")
    for turn in range(s.rounds + 1):
        tight = bounded(shared.where(F.col("df") > s.crowd).select("h"), s.elements)
        crowd = written(entries.join(tight, "h").select("h", "id", "n"), "join-crowded")
        top = written(tops(crowd, moved, s), "join-tops")
        met = left_over(crowd, moved, top, bars, s) if turn else top
        many = lambda met: (met.agg(F.sum("met")).first()[0] or 0) > s.meetings * max(total, 1000)
        if not turn and many(met):
            pairs = written(hubs(crowd, moved, met, s), "join-hubs")
            found = written(verified(pairs, known, sizes, s), "join-linked")
            if not found.isEmpty():
                moved = merged(moved.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(found))
                top = written(tops(crowd, moved, s), "join-tops")
            bars = barred_from(crowd, moved, top, known, s)
            met = left_over(crowd, moved, top, bars, s)
        met = written(met, "join-met")
        if turn == s.rounds or not many(met):
            break
        # What too many documents have goes last as well: these elements, and the rest of what the first and
        # the last document with one of them holds (a passage or a copied text comes as a whole).
        crowded = written(met.orderBy(F.col("met").desc(), "h").limit(s.common).select("h"), "join-crowded")
        if not len(np.setdiff1d(hashes(crowded), late)):
            break
        some = crowd.join(bounded(crowded, s.elements), "h").groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.min_by("id", F.xxhash64("id")).alias("c"))
        leaders = some.select(F.explode(F.array("a", "b", "c")).alias("id")).groupBy("id").agg(F.count("*").alias("k")).orderBy(F.col("k").desc(), "id").limit(s.leaders)
        added = written(crowded.unionByName(elements(known, leaders.select("id"), s)).distinct(), "join-added")
        late = np.union1d(late, hashes(added))
        # prefixes that hold one of them are made anew
        held = written(entries.join(bounded(added, s.elements), "h").select(*row).distinct(), "join-held")
        few = bounded(held, s.broadcast)
        anew = signatures(known.join(bounded(held.select("id").distinct(), s.broadcast), "id", "left_semi"), late, s)
        anew = written(anew if once else anew.join(few, row, "left_semi"), "join-anew")
        old = entries.join(few, row, "left_semi").select(*row, "h")
        reps = reps.join(few, row, "left_anti").unionByName(anew)
        entries = _entries(reps)
        # only elements that went last, or are new to a prefix, need counting again
        fresh = _entries(anew).select(*row, "h").join(old, [*row, "h"], "left_anti").select("h")
        again = bounded(written(fresh.unionByName(added).distinct(), "join-again"), s.elements)
        shared = written(shared.join(again, "h", "left_anti").unionByName(in_several(entries.join(again, "h"))), "join-shared")
    # a crowded element counts with the documents of other components that a document meets there
    shared = shared.join(tight, "h", "left_anti").unionByName(met.select("h", (F.ceil(2 * F.col("met") / F.col("df")) + 1).cast("long").alias("df")))
    shared = written(shared, "join-shared")
    least = F.expr(f"cast((n * {s.percent}L + 99) div 100 as int)")
    entries = written(laned(rooted(entries.drop("digest").join(bounded(shared, s.elements), "h"), moved, s), top, bars, s), "join-entries")
    # l by estimated cost: the meetings of a prefix, of sets of equal size, and a candidate for every l-th of them that has to be verified
    equal = F.expr(f"cast((n * {2 * s.percent}L + {99 + s.percent}) div {100 + s.percent} as int)")
    cost = entries.groupBy("id", "n").agg(*(F.sum(F.when(F.col("at") < F.col("n") - equal + l, F.col("df") - 1).otherwise(0)).alias(f"c{l}") for l in range(1, s.longest + 1)))
    worth = lambda l: F.col(f"c{l}") * (1 + s.verify / l)
    chosen = F.lit(1)
    for l in range(2, s.longest + 1):
        chosen = F.when((F.col("c1") > s.cost) & (least >= l) & (worth(l) < F.least(*map(worth, range(1, l)), F.lit(1e18))), F.lit(l)).otherwise(chosen)
    entries = written(entries.join(cost.select("id", "n", chosen.alias("own")), ["id", "n"]).where(F.col("at") < F.col("n") - least + F.col("own")), "join-prefixes")
    # sets whose sizes are near enough lie in the same band of sizes or the next one
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / s.percent * (1 + 1e-6)))
    # two ways to meet in a crowded element, so that its largest component doesn't meet those that are barred from it
    way = F.when(F.col("lane") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array((F.coalesce("lane", F.lit(0)) / 2).cast("int")))
    entries = entries.withColumn("way", F.explode(way))
    x, y = (entries.select("h", "way", bands.alias("band"), *(F.col(c).alias(f"{c}{i}") for c in ("id", "n", "root", "at", "own", "lane"))) for i, bands in ((1, F.explode(F.array(band, band + 1))), (2, band)))
    both = F.least("own1", "own2")
    # the l-th shared element of sets with enough in common leaves room for the rest in either
    common = F.expr(f"cast(((n1 + n2) * {s.percent}L + {99 + s.percent}) div {100 + s.percent} as int)")
    room = (F.col("at1") <= F.col("n1") - common + both - 1) & (F.col("at2") <= F.col("n2") - common + both - 1)
    first = (F.col("n1") < F.col("n2")) | ((F.col("n1") == F.col("n2")) & (F.col("id1") < F.col("id2")))
    near = F.col("n1") * 100 >= F.col("n2") * s.percent
    once_only = (F.col("way") == 0) | (F.col("lane1") + F.col("lane2") > 2)
    met = x.join(y, ["h", "way", "band"]).where(once_only & first & near & (F.col("id1") != F.col("id2")) & (F.col("root1") != F.col("root2")) & room)
    met = met.select(F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2"), both.alias("need"))
    rest = written(often(met).select(F.col("id1").alias("a"), F.col("id2").alias("b")), "join-pairs")
    more = verified(rest, known, sizes, s)

    # Components over all links that were found: copies, stars and bridges.
    edges = copies.select(F.col("id").alias("a"), F.col("rep").alias("b")).unionByName(moved.select(F.col("id").alias("a"), F.col("root").alias("b"))).unionByName(more)
    found = components(edges, "join-cc2").where("node <> root").select(F.col("node").alias("id"), "root")
    out = sigs.select("id", "n").join(bounded(written(found, "join-components", keep=True), s.broadcast), "id", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.coalesce("root", "id").cast(kind).alias("component_id"))


def representatives(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:  # noqa: B008
    """The rows of docs whose id is the smallest of its component; all rows without id. Rows that repeat an id are all kept.

    Null and empty texts link with nothing and stay; texts are compared whole, however long; an empty table gives no rows.
    """
    name = unused(docs, "gone")
    gone = groups(docs, s, id_col, text_col).where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias(name)).distinct()
    gone = bounded(written(gone, "join-gone"), s.broadcast)
    return docs.join(gone, F.col(id_col) == F.col(name), "left_anti")
