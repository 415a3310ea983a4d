"""Whole runs: from landed pages to a published database.

What is fetched or asked lands outside the engine and comes in as tables, or through
a provider. A failure is a row of the error table with its meeting and stage; the
meeting it belongs to isn't marked seen and comes again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docket.functions.links import protocol_url, refs
from docket.operators import archive, gates, incremental, resolve, validate
from docket.sources import state
from docket.sources.state import cut

KEY = incremental.KEY


def discover(bodies: DataFrame, list_pages: DataFrame, seed_pages: DataFrame, seen: DataFrame, base: str, wrong: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new meetings, diagnostics per body); a body whose list has no links is read from its seed page instead.

    wrong: (committee_slug, error) of bodies whose list could not be fetched; the others are not held up by them.
    """
    known = incremental.confirmed(bodies).select(F.col("slug").alias("committee_slug"))
    listed = refs(list_pages.join(known, "committee_slug", "left_semi"), base)
    silent = known.join(listed, "committee_slug", "left_anti")
    every = listed.unionByName(refs(seed_pages.join(silent, "committee_slug", "left_semi"), base))
    new = incremental.unseen(every, seen)
    return new, incremental.diagnostics(known, new, "committee_slug", wrong)


def with_protocols(meetings: DataFrame, pages: DataFrame, base: str) -> DataFrame:
    """meetings whose landed page links to approved minutes, with that link."""
    joined = meetings.join(pages.select(*KEY, "html"), KEY, "left")
    return incremental.with_protocol(joined.withColumn("protocol_pdf_url", protocol_url(base, F.col("committee_slug"), F.col("date"), F.col("html"))).drop("html"))


def weekly_batch(new: DataFrame, pages: DataFrame, base: str, cap: int = 15) -> DataFrame:
    return incremental.newest(with_protocols(new, pages, base), "date", ["committee_slug"], cap)


def backfill_batch(bodies: DataFrame, slug: str, list_pages: DataFrame, seen: DataFrame, pages: DataFrame, base: str, first: str, last: str, cap: int = 10) -> tuple[DataFrame, DataFrame]:
    """(batch, funnel) of one confirmed body: oldest first within the dates, capped before pages are looked at."""
    if bodies.where((F.col("slug") == slug) & F.col("confirmed")).isEmpty():
        raise ValueError(f"{slug} is not a confirmed body")
    every = refs(list_pages.where(F.col("committee_slug") == slug), base)
    funnel = incremental.funnel(every, seen, F.col("date").between(first, last))
    batch = incremental.oldest(incremental.unseen(incremental.in_range(every, first, last), seen), "date", ["committee_slug"], cap)
    return with_protocols(batch, pages, base), funnel


@dataclass
class Run:
    """What a run leaves: everything is a table."""

    cases: DataFrame
    needs_review: DataFrame
    errors: DataFrame
    seen: DataFrame


def process(
    meetings: DataFrame, texts: DataFrame, answers: DataFrame, verdicts: DataFrame | None, raw_files: DataFrame, existing: DataFrame, seen: DataFrame, run_id: str
) -> Run:
    """Validate, gate, verify, archive and link a batch of meetings.

    meetings: (committee_slug, date, protocol_pdf_url); texts: (pdf_url, text); answers:
    (pdf_url, raw); verdicts: (pdf_url, case_pos, raw), or None to leave verification
    out; existing: (pos, columns of a case). A meeting is seen once its answer could be read.
    """
    url = F.col("protocol_pdf_url")
    asked = meetings.select(*KEY, url.alias("pdf_url")).join(answers.select("pdf_url", "raw"), "pdf_url", "left")
    keys = [*KEY, "pdf_url"]
    parsed, wrong = validate.parse_cases(asked, keys)
    parsed = validate.with_slugs(validate.stamped(parsed, F.col("pdf_url")))
    unread = wrong.where("case_pos is null").select(*KEY).distinct()
    stage = wrong.select(F.lit(run_id).alias("run_id"), F.lit("extract").alias("stage"), *KEY, F.concat_ws(": ", F.concat_ws("/", "case_pos", "step_pos"), "error").alias("error"))

    parsed = parsed.withColumn("key", F.concat_ws("#", "pdf_url", "case_pos"))
    quotes = gates.quotes(parsed, "key").join(parsed.select("key", "pdf_url"), "key")
    checks = state.kept(gates.check(quotes, texts.join(meetings.select(url.alias("pdf_url")).distinct(), "pdf_url", "left_semi"), ["pdf_url"]), "checks")
    gated = gates.all_passed(parsed, checks, ["key"])
    if verdicts is not None:
        said = verdicts.select("pdf_url", "case_pos", validate.parsed_verdict(F.col("raw")).alias("verdict"))
        gated = gated.join(said, ["pdf_url", "case_pos"], "left").withColumn("decision", F.coalesce("verdict.decision", F.lit("review"))).drop("verdict")
    else:
        gated = gated.withColumn("decision", F.lit("publish"))
    gated = gated.withColumn("final_status", validate.reconciled(F.col("passed"), F.col("decision")))
    review = gated.where("final_status = 'needs_review'").join(gates.failed(checks, ["key"]), "key", "left").withColumn("stage", F.when(F.col("passed"), "verify").otherwise("gate"))

    accepted = gated.where("final_status = 'publish'")
    order = accepted.select("key", "date", "committee_slug", "pdf_url", "case_pos").orderBy("date", "committee_slug", "pdf_url", "case_pos")
    order = cut(order.select("key", F.monotonically_increasing_id().alias("cand")))  # keys alone are sorted, by ranges
    ready = archive.marked(accepted, raw_files, "key")
    ready = ready.join(texts.select("pdf_url", "text"), "pdf_url", "left").join(order, "key")
    fields = [c for c in existing.columns if c != "pos"]
    ready = cut(ready)  # the fold reads it many times
    cases, lost = resolve.merged(existing, ready.select("cand", *fields, "text"))
    cases = cut(cases)
    lost = lost.join(ready.select("cand", *KEY), "cand").select(F.lit(run_id).alias("run_id"), F.lit("link").alias("stage"), *KEY, "error")
    done = meetings.select(*KEY).join(unread, KEY, "left_anti")
    return Run(cases, review, stage.unionByName(lost), incremental.mark_seen(seen, done))
