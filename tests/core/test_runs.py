"""A weekly run and a backfill over invented pages, answers and verdicts; the commands."""

import json

import pytest

from docket import schemas
from docket.__main__ import main
from docket.operators import publish
from docket.plans import runs
from docket.sources import state

BASE = "https://portal.example"


def link(slug, date, tail=""):
    return f"<a href='/committees/{slug}/mote-{date}{tail}'>"


@pytest.fixture
def world(spark):
    bodies = spark.createDataFrame([("council", "Council", True, None, None), ("board", "Board", True, None, None), ("old", "Old", False, None, None)], schemas.BODY)
    lists = spark.createDataFrame([("council", link("council", "2024-01-31") + link("council", "2024-02-28") + link("council", "2024-03-31")), ("board", "no links"), ("old", link("old", "2024-01-01"))], "committee_slug string, html string")
    seeds = spark.createDataFrame([("board", link("board", "2024-02-01")), ("council", link("council", "2020-01-01"))], "committee_slug string, html string")
    page = lambda s, d: (s, d, link(s, d, "/protocol/p-1pdf?downloadMode=open"))
    pages = spark.createDataFrame([page("council", "2024-01-31"), ("council", "2024-03-31", "not yet"), page("board", "2024-02-01")], schemas.PAGE)
    seen = spark.createDataFrame([("council", "2024-02-28")], schemas.SEEN)
    return bodies, lists, seeds, pages, seen


def case(title, quote, ref, **more):
    return {"title": title, "initiativ_typ": "motion", "steps": [{"step_id": f"s-{title}", "instance": "the_council", "quote": quote, "date": "2024-01-31", "source": {"protocol_ref": ref}}]} | more


def test_weekly(spark, world):
    bodies, lists, seeds, pages, seen = world
    new, diagnostics = runs.discover(bodies, lists, seeds, seen, BASE)
    assert {r.committee_slug: r.found for r in diagnostics.collect()} == {"council": 2, "board": 1}
    batch = runs.weekly_batch(new, pages, BASE)
    assert [(r.committee_slug, r.date) for r in batch.collect()] == [("board", "2024-02-01"), ("council", "2024-01-31")]
    urls = {r.committee_slug: r.protocol_pdf_url for r in batch.collect()}
    answers = [(urls["council"], json.dumps({"arenden": [case("bike", "a new path", "§1 KF"), case("bridge", "never said", "§2 KF"), case("park", "trees grow", "§3 KF")]})), (urls["board"], "no JSON")]
    texts = [(urls["council"], "§1 first\nWe want a new  path.\n§2 x\n§3 trees\ngrow, see §9 KS")]
    old = {"pos": 0, "id": "a-2023-0001", "title": "old park", "initiativ_typ": "motion", "category": "övrigt", "status": "pågående", "diarienummer": None, "initiators": [], "steps": [{"step_id": "s0", "source": {"protocol_ref": "§9 KS", "pdf_url": "x", "archive_url": None, "wayback_url": None}}], "_link_flag": None}
    existing = spark.createDataFrame([old], schemas.struct(f"pos long, {schemas.CASE}"))
    verdicts = [(urls["council"], 0, '{"decision": "publish"}'), (urls["council"], 2, '{"decision": "publish"}')]
    files = spark.createDataFrame([(urls["council"], "council/p.pdf", "o/cold", 0, b"x")], schemas.struct(schemas.RAW_FILE))
    run = runs.process(batch, spark.createDataFrame(texts, "pdf_url string, text string"), spark.createDataFrame(answers, "pdf_url string, raw string"), spark.createDataFrame(verdicts, "pdf_url string, case_pos int, raw string"), files, existing, seen, "run-1")
    cases = {r.id: r for r in run.cases.collect()}
    assert {k: [s.step_id for s in r.steps] for k, r in cases.items()} == {"a-2023-0001": ["s0", "s-park"], "a-2024-0001": ["s-bike"]}
    bike = cases["a-2024-0001"].steps[0]
    assert (bike.instance, bike.source.archive_url) == ("the-council", "git-pending:o/cold:council/p.pdf")
    assert [(r.title, r.stage, r.failed_checks[0].reason) for r in run.needs_review.collect()] == [("bridge", "gate", "not found")]
    assert [(r.stage, r.committee_slug) for r in run.errors.collect()] == [("extract", "board")]
    # the body whose answer couldn't be read comes again
    assert {r.committee_slug: r.dates for r in run.seen.collect()} == {"council": ["2024-01-31", "2024-02-28"]}
    log = publish.changelog(existing, run.cases, "run-1", "now").first()
    assert (log.new_arenden, [u.id for u in log.updated_arenden], log.arende_count) == (["a-2024-0001"], ["a-2023-0001"], 2)
    assert len(json.loads(publish.database_json(run.cases).first().json)) == 2


def test_backfill(spark, world):
    bodies, lists, _, pages, seen = world
    batch, funnel = runs.backfill_batch(bodies, "council", lists, seen, pages, BASE, "2024-01-01", "2024-02-29")
    assert [r.date for r in batch.collect()] == ["2024-01-31"]
    assert tuple(funnel.first()) == (3, 2, 1, 1)
    with pytest.raises(ValueError, match="confirmed"):
        runs.backfill_batch(bodies, "old", lists, seen, pages, BASE, "2024-01-01", "2024-02-29")


def test_commands(spark, tmp_path, capsys):
    assert main([]) == 2 and main(["hash"]) == 2
    source = {"protocol_ref": "§1 KF", "pdf_url": "u", "archive_url": "git-pending:o/main:p.pdf", "wayback_url": None}
    (tmp_path / "cases.json").write_text(json.dumps([{"id": "a-2024-0001", "title": "t", "steps": [{"step_id": "s", "source": source}]}]))
    (tmp_path / "page.html").write_text(f"<script>{publish.PLACEHOLDER}</script>")
    capsys.readouterr()
    assert main(["hash", f"{tmp_path}/cases.json"]) == 0
    assert len(capsys.readouterr().out.strip()) == 64
    assert main(["permalinks", f"{tmp_path}/cases.json", "https://h", "o/main", "aaa", "o/cold"]) == 0
    assert "https://h/o/main/blob/aaa/p.pdf" in capsys.readouterr().out
    assert main(["build", f"{tmp_path}/page.html", f"{tmp_path}/cases.json"]) == 0
    assert '"title":"t"' in capsys.readouterr().out
    folder = tmp_path / "pages" / "council" / "2024-01-31"
    folder.mkdir(parents=True)
    (folder / "list.html").write_text(link("council", "2024-01-31"))
    assert main(["refs", "council", BASE, f"{tmp_path}/pages", f"{tmp_path}/refs"]) == 0
    assert spark.read.json(f"{tmp_path}/refs").count() == 1
    (tmp_path / "answers.json").write_text(json.dumps({"pdf_url": "u", "raw": json.dumps({"arenden": [case("t", "q", "§1 KF")]})}))
    assert main(["validate", f"{tmp_path}/answers.json", f"{tmp_path}/out"]) == 0
    assert spark.read.json(f"{tmp_path}/out/cases").count() == 1
    assert state.load_cases(spark, f"{tmp_path}/cases.json").count() == 1
