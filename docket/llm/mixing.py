"""Mixing sources to target weights by pivotal dependent rounding (operator 4).

A source's target over its size is how many times each of its documents should be
taken; the whole part is certain, the fraction is a probability. Probabilities are
rounded in pairs: mass moves from one to the other, at random but so that each
keeps its expectation and the two together keep their words, until one of them is
0 or 1. What is left of a pair goes on; groups of such folds form a tree, whose
levels are shuffles of one row a group. A source's largest documents come first,
each paired with all smaller ones together (which share one probability), so that a
source's taken words differ from its target by less than one of the others.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import union_all, written

#: Fixed value: what counts as a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows folded in one group of the tree, on average.
FAN = 48
#: Documents with more than this part of their source's words are large; there are at most so many of a source.
LARGE = 256


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from one row per source.

    The excess over the bound (most times the size) goes to the other sources by
    weight until none is above: the sources of smallest bound for their weight are
    at their bound, all others get one and the same multiple of their weight.
    One row per source passes through one task, no row of a document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sizes.select("source", "source_size", w.cast("double").alias("w"), (F.col("source_size") * F.lit(float(most))).alias("bound"))
    order = Window.orderBy((F.col("bound") / F.col("w")), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select(
        "*",
        (F.sum("source_size").over(all_rows) * F.lit(float(share)) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))).alias("rest"),
        (F.sum("w").over(all_rows) - F.coalesce(F.sum("w").over(before), F.lit(0.0))).alias("rest_w"),
        F.row_number().over(order).alias("k"),
    )
    # the first source whose bound isn't reached sets the multiple
    free = F.col("rest") / F.col("rest_w") < F.col("bound") / F.col("w")
    first = F.min(F.when(free, F.struct("k", (F.col("rest") / F.col("rest_w")).alias("m")))).over(all_rows)
    s = s.withColumn("first", first)
    at_bound = F.col("first").isNull() | (F.col("k") < F.col("first.k"))
    return s.select("source", "source_size", F.when(at_bound, F.col("bound")).otherwise(F.least(F.col("bound"), F.col("w") * F.col("first.m"))).alias("target"))


def chance(*of: Column) -> Column:
    """A number in [0, 1) that only depends on the values."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") / F.lit(float(1 << 53))


def _fold(group: Column, kind: str, seed: int, level: int) -> Column:
    """Fold an array of units (id, size, m, words, p): those decided (id, size, m, up) and the one that is left."""
    unit = f"struct<id:{kind},size:bigint,m:bigint,words:double,p:double>"
    decided = f"array<struct<id:{kind},size:bigint,m:bigint,up:int>>"
    start = F.struct(F.lit(None).cast(unit).alias("left"), F.array().cast(decided).alias("done"))
    names = ("id", "size", "m", "words")

    def pair(acc: Column, b: Column) -> Column:
        a = acc["left"]
        ratio = b["words"] / a["words"]  # what b loses a gains, times this
        up = F.least(1 - a["p"], b["p"] * ratio)  # how far a can rise
        down = F.least(a["p"], (1 - b["p"]) * ratio)
        rises = chance(F.lit(seed), F.lit(level), a["id"], a["size"], b["id"], b["size"]) * (up + down) < down
        # one of the two becomes whole: a at 1 or 0, else b at 0 or 1
        a_ends = F.when(rises, 1 - a["p"] <= b["p"] * ratio).otherwise(a["p"] <= (1 - b["p"]) * ratio)
        new_a = F.when(rises, a["p"] + up).otherwise(a["p"] - down)
        new_b = F.when(rises, b["p"] - up / ratio).otherwise(b["p"] + down / ratio)

        def end(x: Column, whole: Column) -> Column:
            return F.struct(*(x[n].alias(n) for n in names[:3]), whole.cast("int").alias("up"))

        def on(x: Column, p: Column) -> Column:
            return F.struct(*(x[n].alias(n) for n in names), F.least(F.lit(1.0), F.greatest(F.lit(0.0), p)).alias("p"))

        done = F.when(a_ends, end(a, rises)).otherwise(end(b, ~rises))
        left = F.when(a_ends, on(b, new_b)).otherwise(on(a, new_a))
        both = F.struct(left.cast(unit).alias("left"), F.concat(acc["done"], F.array(done).cast(decided)).alias("done"))
        return F.when(a.isNull(), F.struct(b.cast(unit).alias("left"), acc["done"].alias("done"))).otherwise(both)

    return F.aggregate(group, start, pair)


def _large(group: Column, kind: str, seed: int) -> Column:
    """Fold the large units, largest first, against all that come after them.

    The state is the words and the probability of all that is undecided; each unit
    leaves it and moves mass to or from what remains, until the unit is whole. Once
    the remainder is whole instead, every further unit is as the remainder is and
    the unit that moved last is left for the tree.
    """
    unit = f"struct<id:{kind},size:bigint,m:bigint,words:double,p:double>"
    decided = f"array<struct<id:{kind},size:bigint,m:bigint,up:int>>"
    start = F.struct(F.lit(None).cast("double").alias("p"), F.lit(None).cast("double").alias("words"), F.lit(None).cast(unit).alias("left"), F.array().cast(decided).alias("done"))

    def step(acc: Column, u: Column) -> Column:
        p = F.coalesce(acc["p"], u["p"])
        rest = F.greatest(F.lit(0.0), F.coalesce(acc["words"], u["total"]) - u["words"])
        ratio = rest / u["words"]
        up, down = F.least(1 - p, p * ratio), F.least(p, (1 - p) * ratio)
        settled = (p <= 0) | (p >= 1)
        rises = F.when(settled, p >= 1).otherwise(chance(F.lit(seed), F.lit(-2), u["id"], u["size"]) * (up + down) < down)
        ends = settled | F.when(rises, 1 - p <= p * ratio).otherwise(p <= (1 - p) * ratio)
        after = F.when(ends, F.when(rises, p - up / ratio).otherwise(p + down / ratio)).otherwise((~rises).cast("double"))
        after = F.when(~settled & (rest > 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), after))).otherwise(p)
        whole = F.struct(u["id"].alias("id"), u["size"].alias("size"), u["m"].alias("m"), rises.cast("int").alias("up"))
        moved = F.struct(*(u[n].alias(n) for n in ("id", "size", "m", "words")), F.when(rises, p + up).otherwise(p - down).alias("p"))
        return F.struct(
            after.alias("p"),
            rest.alias("words"),
            F.when(ends, acc["left"]).otherwise(moved.cast(unit)).alias("left"),
            F.when(ends, F.concat(acc["done"], F.array(whole).cast(decided))).otherwise(acc["done"]).alias("done"),
        )

    return F.aggregate(group, start, step)


def plan(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, m, source_size, target, copies) for every different (id, source, size); m rows have it.

    weights are dealt to the sources in code point order, null last, again and again.
    Null texts have size 0. Rows alike in id, source and size are one unit and take
    the same number of copies. A source without words has target 0 and copies 0.
    The choice depends on ids, sizes and seed alone, so that reruns agree.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    base = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size_of(F.col(text_col)).alias("size")), "mix-sizes")
    per_source = written(base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "mix-sources")
    goal = targets(per_source, weights, share, most).join(per_source.select(F.col("source").alias("s2"), "n"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(times + 1e-12)
    goal = written(goal.select("*", whole.cast("int").alias("whole"), F.greatest(F.lit(0.0), times - whole).alias("p"), F.ceil(F.col("n") / FAN).alias("groups")), "mix-targets")
    few = goal.count() <= 100_000
    known = (F.broadcast(goal) if few else goal).withColumnRenamed("source", "s2")

    units = base.groupBy("source", "id", "size").agg(F.count("*").alias("m"))
    units = units.join(known, F.col("source").eqNullSafe(F.col("s2")))
    rounded = (F.col("p") > 1e-12) & (F.col("size") > 0)
    units = written(units.select("source", "id", "size", "m", F.when(rounded, F.col("p")).alias("p"), F.pmod(F.xxhash64(F.lit(seed), "id", "size"), "groups").alias("g"), F.col("source_size").cast("double").alias("total")), "mix-units")
    plain = units.where("p is null").select("source", "id", "size", "m", F.lit(0).alias("up"))

    # The tree: every level folds groups of about FAN units to one each.
    top = goal.agg(F.max("groups")).first()[0] or 0
    words = (F.col("size") * F.col("m")).cast("double")
    unit = F.struct("id", "size", "m", words.alias("words"), "p")
    large = words * LARGE > F.col("total")
    first = units.where(F.col("p").isNotNull() & large).groupBy("source").agg(F.sort_array(F.collect_list(F.struct(words.alias("words"), "id", "size", "m", "p", "total")), asc=False).alias("us"))
    first = written(first.select("source", _large(F.col("us"), kind, seed).alias("f")), "mix-large")
    moved = first.select(F.col("source").alias("s3"), F.col("f.p").alias("p3"))
    small = units.where(F.col("p").isNotNull() & ~large).join(F.broadcast(moved) if few else moved, F.col("source").eqNullSafe(F.col("s3")), "left")
    small = small.withColumn("p", F.coalesce("p3", "p"))
    rows = small.select("source", "g", unit.alias("u")).unionByName(first.where("f.left is not null").select("source", F.lit(0).cast("long").alias("g"), F.col("f.left").alias("u")))
    parts, level = [plain, first.select("source", F.explode("f.done").alias("d")).select("source", "d.*")], 0
    while top:
        folded = rows.groupBy("source", "g").agg(F.sort_array(F.collect_list("u")).alias("us"))
        folded = written(folded.select("source", "g", _fold(F.col("us"), kind, seed, level).alias("f")), f"mix-level{level}")
        parts.append(folded.select("source", F.explode("f.done").alias("d")).select("source", "d.*"))
        rows = folded.select("source", F.floor(F.col("g") / FAN).alias("g"), F.col("f.left").alias("u"))
        if top == 1:
            last = chance(F.lit(seed), F.lit(-1), F.col("u.id"), F.col("u.size")) < F.col("u.p")
            parts.append(rows.select("source", "u.id", "u.size", "u.m", last.cast("int").alias("up")))
            break
        top, level = -(-top // FAN), level + 1
    out = union_all(parts).join(known.select("s2", "source_size", "target", "whole"), F.col("source").eqNullSafe(F.col("s2")))
    return out.select("id", "source", "size", "m", "source_size", "target", (F.col("whole") + F.col("up")).alias("copies"))


def taken(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """(id, size, source_size, target, taken) for every row of docs; taken counts words, repeats included.

    An empty table gives no rows; other columns are not read.
    """
    p = plan(docs, id_col=id_col, **kw)
    p = p.select(F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("again"), "*")
    return p.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """The rows of docs, each as often as it is taken, with their columns.

    Null texts and texts without words weigh nothing and come as often as their source's whole copies;
    rows alike in id, source and size are taken equally often; an empty table gives no rows.
    """
    p = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **kw).where("copies > 0")
    p = written(p.select(F.col("id").alias("_i"), F.col("source").alias("_s"), F.col("size").alias("_z"), "copies"), "mix-plan")
    if p.count() <= 500_000:
        p = F.broadcast(p)
    d = docs.select(F.struct(*docs.columns).alias("_d"))
    same = F.col(f"_d.{id_col}").eqNullSafe(F.col("_i")) & F.col(f"_d.{source_col}").eqNullSafe(F.col("_s")) & (size_of(F.col(f"_d.{text_col}")) == F.col("_z"))
    return d.join(p, same).select("_d", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_d.*")
