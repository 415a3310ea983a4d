"""The steps with their sinks: each reads what the one before has left in a folder and leaves its own.

Tables are folders of JSON lines. What lasts (the database, what is published, the seen-set, the logs) is a store: a run
writes into a stage of its own and becomes visible by one rename, all of it or nothing; the same run again changes nothing.
"""

from __future__ import annotations

import traceback
import uuid
from collections.abc import Callable
from functools import wraps
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docket import schemas
from docket.operators import archive, gates, incremental, publish, resolve, validate
from docket.plans import runs
from docket.sources import landed, providers, served, state
from docket.sources.store import Run, Store

CASE_ROW = f"pos long, {schemas.CASE}"
ANSWER = "pdf_url string, raw string"
MINUTES_ROW = "pdf_url string, protocol_ref string, date string, text string"
VERDICT_ROW = "pdf_url string, case_pos int, raw string"
REVIEW_ROW = f"run_id string, stage string, failed_checks array<struct<step_id:string,field:string,reason:string>>, {schemas.CASE}"
RUN_ROW = "run_id string, kind string, found long, in_range long, already_seen long, remaining long, capped boolean, batch long, published long, review long, errors long, failure string"
HASH_ROW = "level int, node long, hash string, n long"
FOUND_ROW = "run_id string, committee_slug string, found long, error string"


def _tidy(step: Callable) -> Callable:
    """A step whose intermediate tables go at its end."""

    @wraps(step)
    def run(spark: SparkSession, *args, **kw):  # noqa: ANN002, ANN003, ANN202
        with state.scratch(spark):
            return step(spark, *args, **kw)

    return run


def rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of JSON lines; no rows if it isn't there."""
    kind = schemas.struct(schema)
    return spark.read.schema(kind).json(path) if state._exists(spark, path) else spark.createDataFrame([], kind)


def left(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def left_document(df: DataFrame, path: str) -> None:
    """The one row's column json as a text document."""
    df.select(F.col("json").alias("value")).coalesce(1).write.mode("overwrite").text(path)


def cases_at(spark: SparkSession, path: str) -> DataFrame:
    """Cases (pos, ...) of a store, of a table that a step has left, or of a JSON document."""
    if state._exists(spark, f"{path}/commits"):
        return Store(spark, path).rows("cases", CASE_ROW)
    first = spark.read.text(path).select(F.trim("value").alias("t")).where("t <> ''").limit(1).first() if state._exists(spark, path) else None
    return state.load_cases(spark, path) if first is None or first.t.startswith("[") else rows(spark, path, CASE_ROW)


def _one_source(spark: SparkSession, path: str) -> DataFrame:
    """(doc, text): one document for all cases."""
    return spark.read.text(path, wholetext=True).agg(F.concat_ws("\n", F.collect_list("value")).alias("text")).select(F.lit(0).alias("doc"), "text")


@_tidy
def extract_step(spark: SparkSession, minutes: str, out: str, provider: providers.Provider) -> None:
    """out/answers, out/cases and out/errors of minutes (pdf_url, protocol_ref, date, text): each text is sent to the model once.

    A request that fails, or an answer that can't be read, is a row of errors with its file.
    """
    known = rows(spark, minutes, MINUTES_ROW)
    asked = known.select("pdf_url", providers.extraction_prompt(F.col("text"), F.coalesce("protocol_ref", F.lit("")), F.coalesce("date", F.lit("")), schemas.INITIATIVE_TYPES, schemas.CATEGORIES).alias("prompt"))
    got = state.kept(providers.asked(asked, "prompt", provider).drop("prompt"), "answers")
    cases, wrong = validate.parse_cases(got.where("error is null"), ["pdf_url"])
    left(got.where("error is null").select("pdf_url", "raw"), f"{out}/answers")
    left(validate.with_slugs(validate.stamped(cases, F.col("pdf_url"))), f"{out}/cases")
    left(wrong.unionByName(got.where("error is not null").select("pdf_url", "error"), allowMissingColumns=True), f"{out}/errors")


@_tidy
def gates_step(spark: SparkSession, cases: str, source: str, out: str) -> None:
    """out/ready and out/needs_review: the cases by the gate, those with their failed checks."""
    known = cases_at(spark, cases)
    checks = gates.check(gates.quotes(known, "pos").withColumn("doc", F.lit(0)), _one_source(spark, source), ["doc"])
    ready, review = gates.split(state.cut(gates.all_passed(known, checks, ["pos"])))
    failed = gates.failed(checks, ["pos"])
    left(ready.select(*known.columns), f"{out}/ready")
    left(review.join(failed, "pos", "left").withColumn("stage", F.lit("gate")).select(*known.columns, "stage", "failed_checks"), f"{out}/needs_review")


@_tidy
def verify_step(spark: SparkSession, ready: str, verdicts: str, out: str) -> None:
    """out/verified and out/review: cases that passed the gate, by their verdicts (case_pos, raw); none is a review."""
    known = cases_at(spark, ready)
    said = rows(spark, verdicts, VERDICT_ROW).select(F.col("case_pos").cast("long").alias("pos"), validate.parsed_verdict(F.col("raw")).alias("verdict"))
    both = known.join(said, "pos", "left").withColumn("final", validate.reconciled(F.lit(True), F.col("verdict.decision")))
    both = state.cut(both)
    left(both.where("final = 'publish'").select(*known.columns), f"{out}/verified")
    left(both.where("final <> 'publish'").withColumn("stage", F.lit("verify")).select(*known.columns, "stage", "verdict"), f"{out}/review")


@_tidy
def archive_step(spark: SparkSession, verified: str, folder: str, listed: str, out: str) -> None:
    """out/archived, out/hashes and out/missing: steps marked by the raw files, the files' hashes, what the manifest lists in vain."""
    files, missing = landed.raw_files(spark, folder, landed.manifest(spark, listed))
    known = cases_at(spark, verified)
    left(archive.marked(known, files, "pos").select(*known.columns), f"{out}/archived")
    left(archive.file_hashes(files), f"{out}/hashes")
    left(missing, f"{out}/missing")


@_tidy
def link_step(spark: SparkSession, archived: str, source: str, database: str, errors: str) -> None:
    """The database (a store) with the cases folded in; new cases that can't have an id go to errors."""
    run = Store(spark, database).begin(f"link-{uuid.uuid4().hex}")
    existing = state.cut(cases_at(spark, database))
    new = cases_at(spark, archived)
    asked = new.crossJoin(F.broadcast(_one_source(spark, source).select("text"))).withColumnRenamed("pos", "cand")
    merged, lost = resolve.merged(existing, state.cut(asked))
    run.write(merged, "cases")
    left(lost, errors)
    run.commit()


def published(run: Run, current: DataFrame, previous: DataFrame, timestamp: str) -> None:
    """What a run publishes, into its stage: the document with its hash, the tree of hashes, and the changelog's row.

    Only the ranges of cases in which this tree isn't like the last committed run's are compared for the changelog.
    """
    spark = current.sparkSession
    whole = state.cut(publish.database_json(current))
    run.text(whole, "published")
    run.text(whole.select(F.sha2("json", 256).alias("json")), "hash")
    run.write(publish.hash_tree(current), "hashes")
    now = spark.read.schema(schemas.struct(HASH_ROW)).json(run.at("hashes"))
    ranges = publish.changed_ranges(run.store.rows("hashes", HASH_ROW), now)
    run.write(publish.changelog(previous, current, run.run_id, timestamp, ranges, whole), "changelog")


@_tidy
def publish_step(spark: SparkSession, database: str, out: str, run_id: str, timestamp: str) -> bool:
    """The store out: cases, published, hash, hashes and changelog of the run, all at once; False if there is no case."""
    current = state.cut(cases_at(spark, database))
    if current.isEmpty():
        return False
    store = Store(spark, out)
    if run := store.begin(run_id):
        previous = state.cut(store.rows("cases", CASE_ROW))
        run.write(current, "cases")
        published(run, current, previous, timestamp)
        run.commit()
    return True


def build_step(spark: SparkSession, template: str, cases: str, out: str) -> None:
    """out/index.html and out/api: the page, and the cases as they are served; out/by-body and out/by-party: the same in folders by year."""
    known = cases_at(spark, cases)
    with open(template, encoding="utf-8") as f:
        page = publish.render(f.read(), known)
    left_document(spark.createDataFrame([(page,)], "json string"), str(PurePosixPath(out) / "index.html"))
    left_document(publish.database_json(known), f"{out}/api")
    served.write(served.bodies(known), "body", f"{out}/by-body")
    served.write(served.parties(known), "party", f"{out}/by-party")


@_tidy
def _whole_run(spark: SparkSession, kind: str, world: str, folder: str, run_id: str, timestamp: str, cap: int, batch_of) -> None:  # noqa: ANN001
    """Batch, process, publish and advance the seen-set, all in one commit of the store folder.

    A run that fails leaves nothing but its row in folder/failures, and can be run again; one that has committed does nothing again.
    """
    store = Store(spark, folder)
    run = store.begin(run_id)
    if run is None:
        return
    row = {"run_id": run_id, "kind": kind, **dict.fromkeys(("found", "in_range", "already_seen", "remaining", "capped", "batch", "published", "review", "errors", "failure"))}
    try:
        seen = state.cut(store.rows("seen", schemas.SEEN))
        batch, counts = batch_of(seen, landed.pages(spark, f"{world}/pages"), run)
        batch = state.cut(batch)
        n = batch.count()  # the cap at most
        row |= counts | {"batch": n, "capped": n >= cap}
        verdicts = rows(spark, f"{world}/verdicts", VERDICT_ROW) if state._exists(spark, f"{world}/verdicts") else None
        files, _ = landed.raw_files(spark, f"{world}/raw", landed.manifest(spark, f"{world}/manifest")) if state._exists(spark, f"{world}/manifest") else (spark.createDataFrame([], schemas.struct(schemas.RAW_FILE)), None)
        existing = state.cut(store.rows("cases", CASE_ROW))
        done = runs.process(batch, rows(spark, f"{world}/texts", "pdf_url string, text string"), rows(spark, f"{world}/answers", ANSWER), verdicts, files, existing, seen, run_id)
        row |= {"published": run.write(done.cases, "cases"), "review": run.write(done.needs_review.withColumn("run_id", F.lit(run_id)), "needs_review"), "errors": run.write(done.errors, "errors")}
        published(run, done.cases, existing, timestamp)
        run.write(done.seen.select("committee_slug", F.explode("dates").alias("date")), "seen")
        run.write(spark.createDataFrame([row], RUN_ROW), "runs")
        run.commit()
    except Exception as e:
        row["failure"] = "".join(traceback.format_exception_only(e)).strip()[:2000]
        left(spark.createDataFrame([row], RUN_ROW), f"{folder}/failures", append=True)
        raise


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all runs: of committed ones, and of attempts that failed."""
    return Store(spark, folder).log("runs", RUN_ROW).unionByName(rows(spark, f"{folder}/failures", RUN_ROW))


def weekly(spark: SparkSession, world: str, folder: str, base: str, run_id: str, timestamp: str, cap: int = 15) -> None:
    """A weekly run over what has landed in world (bodies, lists, list_errors, seeds, pages, texts, answers, verdicts, raw, manifest), state in the store folder."""

    def batch_of(seen: DataFrame, pages: DataFrame, run: Run) -> tuple[DataFrame, dict]:
        html = "committee_slug string, html string"
        wrong = rows(spark, f"{world}/list_errors", "committee_slug string, error string")
        new, found = runs.discover(rows(spark, f"{world}/bodies", schemas.BODY), rows(spark, f"{world}/lists", html), rows(spark, f"{world}/seeds", html), seen, base, wrong)
        run.write(found.withColumn("run_id", F.lit(run_id)), "diagnostics")
        total = spark.read.schema(schemas.struct(FOUND_ROW)).json(run.at("diagnostics")).agg(F.coalesce(F.sum("found"), F.lit(0))).first()[0]
        return runs.weekly_batch(new, pages, base, cap), {"found": total, "remaining": total}

    _whole_run(spark, "weekly", world, folder, run_id, timestamp, cap, batch_of)


def backfill(spark: SparkSession, world: str, folder: str, base: str, run_id: str, timestamp: str, slug: str, first: str, last: str, cap: int = 10) -> None:
    """A backfill of one confirmed body between two dates, over the same folders."""

    def batch_of(seen: DataFrame, pages: DataFrame, run: Run) -> tuple[DataFrame, dict]:  # noqa: ARG001
        batch, funnel = runs.backfill_batch(rows(spark, f"{world}/bodies", schemas.BODY), slug, rows(spark, f"{world}/lists", "committee_slug string, html string"), seen, pages, base, first, last, cap)
        r = funnel.first()
        return batch, {"found": r.total, "in_range": r.in_range, "already_seen": r.already_seen, "remaining": r.remaining}

    _whole_run(spark, "backfill", world, folder, run_id, timestamp, cap, batch_of)


ANSWERED = "committee_slug string, date string, protocol_pdf_url string, raw string"


def link_batches(world: str, folder: str, timestamp: Callable[[int], str]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over landed answers (ANSWERED): each batch goes through gate, link and publication into the store folder, in one commit.

    The batch's number is the run's id, so that a batch that is delivered again changes nothing. Texts come from world/texts, files
    from world/raw by world/manifest, verdicts from world/verdicts. Batches fold in the order in which they come, as one batch of them all does
    if answers land in the order of their dates.
    """

    @_tidy
    def linked(session: SparkSession, batch: DataFrame, number: int) -> None:
        store = Store(session, folder)
        run = store.begin(f"batch-{number}")
        if run is None:
            return
        batch = state.cut(batch)
        meetings, answers = batch.drop("raw"), batch.select(F.col("protocol_pdf_url").alias("pdf_url"), "raw")
        verdicts = rows(session, f"{world}/verdicts", VERDICT_ROW) if state._exists(session, f"{world}/verdicts") else None
        files = landed.raw_files(session, f"{world}/raw", landed.manifest(session, f"{world}/manifest"))[0] if state._exists(session, f"{world}/manifest") else session.createDataFrame([], schemas.struct(schemas.RAW_FILE))
        existing, seen = state.cut(store.rows("cases", CASE_ROW)), state.cut(store.rows("seen", schemas.SEEN))
        done = runs.process(meetings, rows(session, f"{world}/texts", "pdf_url string, text string"), answers, verdicts, files, existing, seen, run.run_id)
        run.write(done.cases, "cases")
        run.write(done.needs_review.withColumn("run_id", F.lit(run.run_id)), "needs_review")
        run.write(done.errors, "errors")
        run.write(done.seen.select("committee_slug", F.explode("dates").alias("date")), "seen")
        published(run, done.cases, existing, timestamp(number))
        run.commit()

    return lambda batch, number: linked(batch.sparkSession, batch, number)


def fold_batches(folder: str, case: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over candidates (cand, case's columns, text): each batch is folded into the cases of the store folder, in one commit.

    case: the columns of the store's cases, with pos. Candidates come in their order, and a batch that is delivered again changes nothing.
    """

    @_tidy
    def folded(session: SparkSession, batch: DataFrame, number: int) -> None:
        store = Store(session, folder)
        run = store.begin(f"batch-{number}")
        if run is None:
            return
        cases, lost = resolve.merged(state.cut(store.rows("cases", case)), state.cut(batch))
        run.write(cases, "cases")
        run.write(lost, "errors")
        run.commit()

    return lambda batch, number: folded(batch.sparkSession, batch, number)


def fetch_step(spark: SparkSession, lists: DataFrame, pages: DataFrame, seen: DataFrame, base: str, out: str) -> None:
    """out/meetings: unseen meetings of landed list pages (committee_slug, html) whose landed page links to approved minutes."""
    left(runs.with_protocols(incremental.unseen(runs.refs(lists, base), seen), pages, base), f"{out}/meetings")
