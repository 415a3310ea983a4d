"""Publication: canonical JSON, hashes, differences between snapshots, changelog, views."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket.functions.archive import is_pending
from docket.functions.text import inline_script
from docket.sources.state import kept

PLACEHOLDER = "/*__CASES__*/"


def canonical(json: Column) -> Column:
    """JSON text with the keys of objects sorted at every depth, lists as they are, nulls kept."""
    return F.to_json(F.parse_json(json))


def data_hash(json: Column) -> Column:
    return F.sha2(canonical(json), 256)


def case_json(cases: DataFrame) -> Column:
    fields = [c for c in cases.columns if c != "pos"]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def database_json(cases: DataFrame) -> DataFrame:
    """One row (json, n): all cases in their order, each in canonical form.

    The one step that needs all cases at once: what is published is one document.
    """
    rows = cases.select("pos", canonical(case_json(cases)).alias("j"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "j"))), lambda r: r["j"])
    return rows.agg(F.concat(F.lit("["), F.array_join(ordered, ","), F.lit("]")).alias("json"), F.count("*").alias("n"))


def document_hash(cases: DataFrame) -> DataFrame:
    """One row (data_hash, n): the SHA-256 of what database_json gives, without the document.

    Cases become JSON, and ranges of them text, in parallel; the hash of a document goes on from each byte to the next, so that
    one task reads the sorted ranges as a stream. It holds a batch at a time.
    """
    at = F.floor(F.col("pos") / RANGE)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "j"))), lambda r: r["j"])
    ranges = cases.select(at.alias("node"), "pos", canonical(case_json(cases)).alias("j")).groupBy("node").agg(F.array_join(ordered, ",").alias("text"), F.count("*").alias("n"))

    def streamed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        h, n = hashlib.sha256(b"["), 0
        for batch in batches:
            for text, k in zip(batch.column(0), batch.column(1), strict=True):
                h.update(b"," if n else b"")
                h.update(text.as_py())
                n += k.as_py()
        h.update(b"]")
        yield pa.RecordBatch.from_pydict({"data_hash": [h.hexdigest()], "n": pa.array([n], pa.int64())})

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if cases.sparkSession.conf.get(key, None) is None:
        cases.sparkSession.conf.set(key, str(4 << 20))
    whole = ranges.repartition(1).sortWithinPartitions("node").select(F.encode("text", "UTF-8").alias("text"), "n")
    return whole.mapInArrow(streamed, "data_hash string, n long").groupBy().agg(F.first("data_hash").alias("data_hash"), F.coalesce(F.max("n"), F.lit(0)).alias("n")).withColumn("data_hash", F.coalesce("data_hash", F.sha2(F.lit("[]"), 256)))


#: Positions of a range, which is a leaf of the tree of hashes, and nodes below another one.
RANGE, FAN = 1024, 64


def hash_tree(cases: DataFrame, size: int = RANGE, fan: int = FAN, levels: int | None = None) -> DataFrame:
    """(level, node, hash, n): hashes of ranges of positions from those of their cases, and of nodes from those below, up to one root.

    levels: how many there are at most, for a reader that expects so many; the last one then has several nodes.

    No step holds more than a range's or a node's hashes. Where nothing was published there is no row. Levels are made one by one
    from tables, as many as the number of cases has powers of fan.
    """
    each = cases.select(F.floor(F.col("pos") / size).alias("node"), "pos", F.sha2(canonical(case_json(cases)), 256).alias("h"))

    def above(df: DataFrame, at: str, level: int, n: Column) -> DataFrame:
        ordered = F.transform(F.array_sort(F.collect_list(F.struct(at, "h"))), lambda r: r["h"])
        return df.groupBy("node").agg(F.sha2(F.concat_ws("", ordered), 256).alias("hash"), n.alias("n")).select(F.lit(level).alias("level"), "node", "hash", "n")

    level = kept(above(each, "pos", 0, F.count("*")), "hashes")
    tree, top = level, level.agg(F.max("node")).first()[0]
    made = 1
    while top and made != levels:
        below = level.select(F.floor(F.col("node") / fan).alias("node"), F.col("node").alias("at"), F.col("hash").alias("h"), "n")
        level = kept(above(below, "at", made, F.sum("n")), "hashes")
        tree, top, made = tree.unionByName(level), top // fan, made + 1
    return tree


def changed_ranges(before: DataFrame, after: DataFrame) -> DataFrame:
    """(node): the ranges of after's tree that before's doesn't have alike; walked from the root, so that equal branches aren't looked into."""
    spark = after.sparkSession
    top, was = (df.select(F.max("level")).first()[0] for df in (after, before))
    if top is None:
        return spark.createDataFrame([], "node long")
    unlike = after.join(before.select("level", "node", "hash"), ["level", "node", "hash"], "left_anti")
    start = min(top, -1 if was is None else was)  # above that the trees have no nodes in common
    if start < 0:
        return after.where("level = 0").select("node")
    found = unlike.where(F.col("level") == start).select("node")
    for level in range(start - 1, -1, -1):
        parents = found.select(F.col("node").alias("up"))
        found = unlike.where(F.col("level") == level).withColumn("up", F.floor(F.col("node") / FAN)).join(parents, "up", "left_semi").select("node")
    return found


def difference(previous: DataFrame, current: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """(pos, id, is_new, new_step_ids) of cases that are new or have new steps; removals and edits don't count.

    ranges: those of current that can have changed (changed_ranges); cases keep their positions, so that the others need no look.
    """
    if ranges is not None:
        changed = ranges.select(F.col("node").alias("_node"))
        current, previous = (df.join(changed, F.floor(F.col("pos") / RANGE) == F.col("_node"), "left_semi") for df in (current, previous))
    ids = F.transform("steps", lambda s: s["step_id"])  # before the join, so that no steps are shuffled
    before = previous.select("id", ids.alias("_known"), F.lit(True).alias("_was"))
    joined = current.select("pos", "id", ids.alias("_ids")).join(before, "id", "left")
    more = F.filter("_ids", lambda i: ~F.coalesce(F.array_contains("_known", i), F.lit(False)))
    out = joined.select("pos", "id", F.col("_was").isNull().alias("is_new"), F.when(F.col("_was").isNull(), F.array().cast("array<string>")).otherwise(more).alias("new_step_ids"))
    return out.where(F.col("is_new") | (F.size("new_step_ids") > 0))


def changelog(previous: DataFrame, current: DataFrame, run_id: str, timestamp: str, ranges: DataFrame | None = None, whole: DataFrame | None = None) -> DataFrame:
    """The run's changelog row. ranges: as difference takes them; whole: what database_json gave for current, if that is there."""
    diff = difference(previous, current, ranges)
    lists = diff.agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("is_new"), F.struct("pos", "id")))), lambda r: r["id"]).alias("new_arenden"),
        F.transform(F.array_sort(F.collect_list(F.when(~F.col("is_new"), F.struct("pos", "id", "new_step_ids")))), lambda r: F.struct(r["id"].alias("id"), r["new_step_ids"].alias("new_step_ids"))).alias("updated_arenden"),
    )
    row = (database_json(current) if whole is None else whole).select(F.sha2("json", 256).alias("data_hash"), F.col("n").alias("arende_count"))
    return row.crossJoin(lists).select(F.lit(run_id).alias("run_id"), F.lit(timestamp).alias("timestamp"), "data_hash", "arende_count", "new_arenden", "updated_arenden")


def changelog_counts(previous: DataFrame, current: DataFrame, run_id: str, timestamp: str, ranges: DataFrame | None = None) -> DataFrame:
    """changelog's row with the lengths of its lists (n_new, n_updated) in their place, however many cases there are; what would be in them are difference's rows."""
    counts = difference(previous, current, ranges).agg(F.count_if("is_new").alias("n_new"), F.count_if(~F.col("is_new")).alias("n_updated"))
    row = document_hash(current).select("data_hash", F.col("n").alias("arende_count"))
    return row.crossJoin(counts).select(F.lit(run_id).alias("run_id"), F.lit(timestamp).alias("timestamp"), "data_hash", "arende_count", "n_new", "n_updated")


def render(template: str, cases: DataFrame) -> str:
    """The page with the cases in place of the first placeholder; an error if the template has none."""
    if PLACEHOLDER not in template:
        raise ValueError(f"the template has no {PLACEHOLDER}")
    json = database_json(cases).select(inline_script(F.col("json"))).first()[0]
    return template.replace(PLACEHOLDER, json, 1)


def by_body(cases: DataFrame, slug: str) -> DataFrame:
    return cases.where(F.exists("steps", lambda s: s["instance"] == slug))


def by_party(cases: DataFrame, party: str) -> DataFrame:
    """Cases that the party began or made a reservation or note in."""
    in_step = lambda s: F.exists(s["reservations"], lambda r: F.array_contains(r["parties"], party)) | F.exists(s["protocol_anteckning"], lambda r: F.array_contains(r["parties"], party))
    return cases.where(F.coalesce(F.exists("initiators", lambda i: i["party"] == party), F.lit(False)) | F.coalesce(F.exists("steps", lambda s: F.coalesce(in_step(s), F.lit(False))), F.lit(False)))


def _searched(title: Column, steps: Column) -> Column:
    return F.lower(F.concat_ws(" ", title, F.transform(steps, lambda s: s["quote"])))


def search(cases: DataFrame, words: str, slug: str | None = None, status: str | None = None) -> DataFrame:
    """Cases whose title or quotations contain the words, in any case; optionally of a body and a status."""
    out = cases.where(_searched(F.col("title"), F.col("steps")).contains(words.lower()))
    if slug is not None:
        out = by_body(out, slug)
    return out if status is None else out.where(F.col("status") == status)


#: Characters of the runs that the index has, and folders that it is dealt to.
GRAM, FOLDERS = 3, 256


def _grams(text: Column) -> Column:
    """The different runs of GRAM characters of a text."""

    def of(c: Column) -> Column:
        at = F.when(F.size(c) >= GRAM, F.sequence(F.lit(0), F.size(c) - GRAM)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(at, lambda i: F.concat(*(F.get(c, i + k) for k in range(GRAM)))))

    return F.get(F.transform(F.array(F.split(text, "")), of), F.lit(0))


def _folder(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(FOLDERS)).cast("int").alias("folder")


def write_search_index(cases: DataFrame, path: str) -> None:
    """Postings (gram, pos) of what search looks at, in folders by a hash of the gram and sorted within, so that a search reads its grams alone."""
    postings = cases.select("pos", F.explode(_grams(_searched(F.col("title"), F.col("steps")))).alias("gram")).select(_folder(F.col("gram")), "gram", "pos")
    # a gram that most cases have is dealt to several files
    dealt = postings.repartition("folder", F.pmod(F.xxhash64("pos"), F.lit(4))).sortWithinPartitions("folder", "gram", "pos")
    dealt.write.mode("overwrite").partitionBy("folder").parquet(path)


def search_indexed(cases: DataFrame, index: str, words: str, slug: str | None = None, status: str | None = None) -> DataFrame:
    """As search, by the index at a path: cases with all grams of the words, then looked at. Words of fewer than GRAM characters have none: all cases are looked at."""
    spark = cases.sparkSession
    asked = spark.range(1).select(F.explode(_grams(F.lower(F.lit(words)))).alias("gram")).select("gram", _folder(F.col("gram"))).collect()  # as long as the words
    if not asked:
        return search(cases, words, slug, status)
    postings = spark.read.schema("gram string, pos long, folder int").parquet(index)
    mine = postings.where(F.col("folder").isin(*{r.folder for r in asked}) & F.col("gram").isin(*(r.gram for r in asked)))
    able = mine.groupBy("pos").agg(F.count("*").alias("n")).where(F.col("n") == len(asked)).select("pos")
    return search(cases.join(able, "pos", "left_semi"), words, slug, status)


def shown_link(archive_url: Column) -> Column:
    """An archive link, hidden while it waits for its commit."""
    return F.when(~is_pending(archive_url), archive_url)
