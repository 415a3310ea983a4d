"""The verbatim gate: every quotation must stand word for word in its own source."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.functions.text import is_blank, normal_space, word_count
from docket.sources.state import kept

#: Words that a quotation may have, by the step's type and else.
WORD_LIMITS = {"namndyttrande": 60}
DEFAULT_LIMIT = 40
EMPTY, TOO_LONG, FOUND, MISSING = "empty", "too long", "verified", "not found"


def word_limit(step_type: Column) -> Column:
    limits = F.create_map(*(F.lit(x) for pair in WORD_LIMITS.items() for x in pair))
    return F.coalesce(F.element_at(limits, step_type), F.lit(DEFAULT_LIMIT))


def verdict(quote: Column, normal_quote: Column, normal_source: Column, limit: Column | None) -> Column:
    """One reason, in this order: empty, too long (null limit: never), verified or not found."""
    reason = F.when(is_blank(quote), F.lit(EMPTY))
    if limit is not None:
        reason = reason.when(word_count(normal_quote) > limit, F.lit(TOO_LONG))
    return reason.when(normal_source.contains(normal_quote), F.lit(FOUND)).otherwise(F.lit(MISSING))


def quotes(cases: DataFrame, key: str = "case_pos") -> DataFrame:
    """(key, step_pos, kind, quote_pos, step_id, field, quote, word_limit): what the gate checks; empty strings and nulls aren't checks."""
    steps = cases.select(key, F.posexplode("steps").alias("step_pos", "s"))
    main = steps.select(key, "step_pos", F.lit(0).alias("kind"), F.lit(0).alias("quote_pos"), "s.step_id", F.lit("quote").alias("field"), "s.quote", word_limit(F.col("s.type")).alias("word_limit"))

    def statements(kind: int, name: str) -> DataFrame:
        each = steps.select(key, "step_pos", "s.step_id", F.posexplode(f"s.{name}").alias("quote_pos", "r"))
        field = F.concat(F.lit(f"{name}[" if name == "protocol_anteckning" else "reservation["), F.concat_ws("+", "r.parties"), F.lit("]"))
        return each.select(key, "step_pos", F.lit(kind).alias("kind"), "quote_pos", "step_id", field.alias("field"), F.col("r.quote").alias("quote"), F.lit(None).cast("int").alias("word_limit"))

    every = main.unionByName(statements(1, "reservations")).unionByName(statements(2, "protocol_anteckning"))
    return every.where(F.coalesce(F.col("quote"), F.lit("")) != "")


#: Words of a run that quotations are found by, of a segment that a place is looked up in, and of a part that is compared at once.
RUN, SEGMENT, PART = 3, 256, 64
#: Places of a run in one source that are tried before the whole source is searched instead.
PLACES = 16


def normalised(sources: DataFrame, on: list[str]) -> DataFrame:
    """(on..., _n): the texts of sources (on..., text) with normal space; without nulls and blank ones."""
    normal = sources.select(*on, normal_space(F.col("text")).alias("_n"))
    return normal.where("_n is not null and _n <> ''")


def check(quotes: DataFrame, sources: DataFrame, on: list[str]) -> DataFrame:
    """quotes with (passed, reason). sources: (on..., text), one text for each, or what normalised() made of them; a missing source is an empty one.

    Sources and quotations are dealt out by their keys once each, and meet there at the places of a run of the quotations'
    words (located), so that the work grows with the texts and not with texts times quotations. What was found is written as digests
    (96 bits beside the key) and no text goes further than that; quotes is read twice, and must give the same rows both times.
    """
    normal = sources if "_n" in sources.columns else normalised(sources, on)
    limit = F.when(F.col("word_limit").isNull(), F.lit(2**31 - 1)).otherwise(F.col("word_limit"))
    text = F.coalesce(normal_space(F.col("quote")), F.lit(""))
    asked = quotes.select("*", F.explode(F.array(text)).alias("_quote"))  # made once for all its uses
    early = F.when(F.col("_quote") == "", F.lit(EMPTY)).when(word_count(F.col("_quote")) > limit, F.lit(TOO_LONG))
    with dealt_alike(quotes.sparkSession):
        found = located(asked.where(early.isNull()).select(*on, "_quote"), normal, on)
        found = kept(found.select(*on, *digest(F.col("_quote")), F.lit(True).alias("_found")), "found")
    asked = asked.withColumn("_early", early)
    parts = [F.when(F.col("_early").isNull(), d).alias(name) for name, d in zip(DIGEST, digest(F.col("_quote")), strict=True)]
    out = asked.select(*quotes.columns, "_early", *parts).join(found, [*on, *DIGEST], "left")
    reason = F.coalesce("_early", F.when(F.col("_found"), F.lit(FOUND)).otherwise(F.lit(MISSING)))
    return out.select(*quotes.columns, reason.alias("reason")).withColumn("passed", F.col("reason") == FOUND)


DIGEST = ["_a", "_b"]


def digest(c: Column) -> list[Column]:
    return [F.xxhash64(c).alias(DIGEST[0]), F.hash(c).alias(DIGEST[1])]


@contextmanager
def dealt_alike(spark: SparkSession) -> Iterator[None]:
    """What runs inside joins tables that are dealt out by some of the join's keys where they are, without dealing them anew by all keys."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def located(known: DataFrame, normal: DataFrame, on: list[str]) -> DataFrame:
    """Those of known (on..., _quote) that stand in their own source, once each. normal: (on..., _n); both with normal space.

    A quotation's first and last word may be parts of the source's words, those between are whole ones. One run of these (the one with
    the least hash; of three and four words a single word) is looked up among the source's runs. At each place that it has, the
    quotation is compared with the source's words, in parts and within segments, so that no comparison looks further than its own
    place. Where a run has very many places and the first few don't fit, and for one or two words, the source is searched.

    Both are dealt out by on, and all that follows stays there (dealt_alike); the words' runs are looked up in
    hashed tables of what is wanted, so that neither they nor the texts are shuffled or sorted again.
    """
    have = reduce(Column.__and__, (F.col(c).isNotNull() for c in on))
    whole = normal.where(have).select(*on, "_n").repartition(*on)
    asked = known.where(have).select(*on, "_quote").repartition(*on).select(*on, "_quote", F.explode(F.array(F.split("_quote", " "))).alias("_q"))
    several = asked.where(F.size("_q") > 2)
    one = F.size("_q") < RUN + 2  # looked up by a single word

    def runs(x: Column, k: int, first: int, last: int) -> Column:
        """Hashes of each run of k words, without the first and last ones."""
        at = F.when(F.size(x) >= k + first + last, F.sequence(F.lit(first), F.size(x) - k - last)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(*(F.get(x, i + j) for j in range(k))))

    least = lambda k: F.array_min(F.transform(runs(F.col("_q"), k, 1, 1), lambda h, i: F.struct(h.alias("h"), (i + 1).alias("off"))))
    mine = several.select(*on, "_quote", "_q", F.explode(F.array(F.when(one, least(1)).otherwise(least(RUN)))).alias("a")).select(*on, "_quote", "_q", "a.h", "a.off")

    # a text's runs of words, then its single words if some quotation is looked up by one
    singly = several.where(one).select(*on).distinct().withColumn("_one", F.lit(True))
    texts = whole.join(singly.hint("shuffle_hash"), on, "left").select(*on, "_one", F.explode(F.array(F.split("_n", " "))).alias("_w"))
    singles = F.when(F.col("_one"), runs(F.col("_w"), 1, 0, 0)).otherwise(F.array().cast("array<bigint>"))
    n_runs = F.greatest(F.size("_w") - RUN + 1, F.lit(0))
    places = texts.select(*on, n_runs.alias("_k"), F.posexplode(F.concat(runs(F.col("_w"), RUN, 0, 0), singles)).alias("p", "h"))
    wanted = places.join(mine.select(*on, "h").hint("shuffle_hash"), [*on, "h"], "left_semi")
    wanted = wanted.select(*on, "h", F.when(F.col("p") < F.col("_k"), F.col("p")).otherwise(F.col("p") - F.col("_k")).alias("p"))
    where = wanted.groupBy(*on, "h").agg(F.slice(F.array_sort(F.collect_list("p")), 1, PLACES).alias("at"), F.count("*").alias("n"))
    met = mine.join(where.hint("shuffle_hash"), [*on, "h"])

    starts = F.filter(F.transform("at", lambda p: p - F.col("off")), lambda p: p >= 0)
    tried = met.select(*on, "_quote", "_q", "n", F.explode_outer(starts).alias("start"))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("_q") - 1) / PART).cast("int")), lambda j: F.slice("_q", j * PART + 1, PART))
    part = F.struct(F.size("w").alias("m"), F.length(F.get("w", F.lit(0))).alias("first"), F.array_join("w", " ").alias("w"))
    tried = tried.select(*on, "_quote", "n", "start", F.size(cut).alias("of"), F.posexplode(cut).alias("j", "w")).select(*on, "_quote", "n", "start", "of", "j", part.alias("x"))
    tried = tried.withColumn("p", F.col("start") + F.col("j") * PART).withColumn("seg", F.floor(F.col("p") / SEGMENT).cast("int"))
    words = whole.select(*on, F.explode(F.array(F.split("_n", " "))).alias("_w"))
    segments = F.transform(F.sequence(F.lit(0), F.floor((F.size("_w") - 1) / SEGMENT).cast("int")), lambda i: F.slice("_w", i * SEGMENT + 1, SEGMENT + PART))
    there = tried.hint("shuffle_hash").join(words.select(*on, F.posexplode(segments).alias("seg", "s")), [*on, "seg"], "left")
    own = F.slice("s", F.col("p") % SEGMENT + 1, F.col("x.m"))
    there = there.select(*on, "_quote", "n", "start", "of", "j", "x", F.explode_outer(F.array(own)).alias("s"))
    before = F.when(F.col("j") == 0, F.length(F.get("s", F.lit(0))) - F.col("x.first")).otherwise(0)  # of the source's first word
    text = F.substr(F.array_join("s", " "), before + 1)
    fits = F.when(F.col("j") == F.col("of") - 1, text.startswith(F.col("x.w"))).otherwise(text == F.col("x.w"))
    same = F.coalesce((F.size("s") == F.col("x.m")) & (before >= 0) & fits, F.lit(False))
    tries = there.groupBy(*on, "_quote", "n", "start").agg(F.bool_and(same).alias("right"))  # all parts of a place
    tries = tries.groupBy(*on, "_quote", "n").agg(F.bool_or("right").alias("right"))
    judged = tries.where(F.col("right") | (F.col("n") > PLACES)).join(whole.hint("shuffle_hash"), on, "left")
    right = judged.where(F.col("right") | F.col("_n").contains(F.col("_quote"))).select(*on, "_quote")
    short = asked.where(F.size("_q") < 3).select(*on, "_quote").distinct()
    searched = short.hint("shuffle_hash").join(whole, on).where(F.col("_n").contains(F.col("_quote"))).select(*on, "_quote")
    return right.unionByName(searched)


def candidates(passages: DataFrame, sources: DataFrame, on: list[str], size: int = RUN) -> DataFrame:
    """passages x sources (on..., text, or what normalised() made of them) that can contain them at any position; none that does is left out. passages: (quote, ...).

    A passage's first and last word may be parts of the source's words, those between are whole ones:
    its rarest run of size words (or one, if it hasn't so many between) is looked up among those of the whole texts. A passage
    of one or two words is looked up by its first characters, three at most, among the texts' runs of so many. Single
    words and characters of the texts are only looked at if some passage needs them. Blank passages and null texts have no candidates.
    """
    known = passages.where(~is_blank(F.col("quote"))).distinct()
    known = known.withColumn("_p", F.xxhash64(*known.columns)).withColumn("_n", normal_space(F.col("quote"))).withColumn("_w", F.split("_n", " "))
    texts = sources if "_n" in sources.columns else sources.select(*on, normal_space(F.col("text")).alias("_n")).where("_n is not null")

    def runs(x: Column, k: int, first: int, last: int) -> Column:
        """Hashes of each run of k words or characters, without the first and last ones."""
        n = F.size(x) - first - last - k + 1
        at = F.when(n > 0, F.sequence(F.lit(first), n + first - 1)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(at, lambda i: F.xxhash64(F.lit(k), *(F.get(x, i + j) for j in range(k)))))

    def of_text(own: Column, k: int) -> Column:
        return F.get(F.transform(F.array(own), lambda x: runs(x, k, 0, 0)), F.lit(0))  # the text is split once

    several = F.size("_w") >= size + 2
    kinds = {("word", size): several, ("word", 1): (F.size("_w") > 2) & ~several}
    kinds |= {("character", k): (F.size("_w") <= 2) & (F.length("_n") >= 3 if k == 3 else F.length("_n") == k) for k in (1, 2, 3)}
    needed = known.agg(*(F.count_if(c).alias(f"{unit}{k}") for (unit, k), c in kinds.items())).first()  # one row of counts
    wanted, have = [], []
    for (unit, k), which in kinds.items():
        if not needed[f"{unit}{k}"]:
            continue
        mine, edge = known.where(which), int(unit == "word")
        own = F.split("_n", " " if edge else "")
        wanted.append(mine.select("_p", F.explode(runs(own, k, edge, edge)).alias("_g")))
        have.append(texts.select(*on, F.explode(of_text(own, k)).alias("_g")).join(wanted[-1].select("_g").distinct(), "_g", "left_semi"))
    if not wanted:
        return sources.where("false").select(*on).join(passages.where("false"), F.lit(False)).select(*on, *passages.columns)
    asked, met = reduce(DataFrame.unionByName, wanted), kept(reduce(DataFrame.unionByName, have), "runs")
    often = met.groupBy("_g").agg(F.count("*").alias("_n"))
    rarest = asked.join(often, "_g", "left").groupBy("_p").agg(F.min_by("_g", F.struct(F.coalesce("_n", F.lit(0)), "_g")).alias("_g"))
    return met.join(rarest, "_g").select(*on, "_p").distinct().join(known, "_p").select(*on, *passages.columns)


def all_passed(cases: DataFrame, checks: DataFrame, on: list[str]) -> DataFrame:
    """cases with (n_checks, passed): passed if there are checks and all of them passed."""
    by_case = checks.groupBy(*on).agg(F.count("*").alias("n_checks"), F.bool_and("passed").alias("_all"))
    out = cases.join(by_case, on, "left")
    out = out.withColumn("n_checks", F.coalesce("n_checks", F.lit(0)))
    return out.withColumn("passed", F.coalesce(F.col("_all"), F.lit(False))).drop("_all")


def failed(checks: DataFrame, on: list[str]) -> DataFrame:
    """(on..., failed_checks): what failed of each case, by step and field."""
    return checks.where("not passed").groupBy(*on).agg(F.array_sort(F.collect_list(F.struct("step_id", "field", "reason"))).alias("failed_checks"))


def split(gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ready, needs_review)."""
    return gated.where("passed"), gated.where("not passed")
