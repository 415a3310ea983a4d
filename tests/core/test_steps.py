"""The steps with their sinks, on small folders; fetching without a network."""

import json
import zlib

import pytest

from docket import schemas
from docket.__main__ import main
from docket.plans import steps
from docket.sources import fetch
from docket.sources.store import Run, Store, Taken
from docket.streaming import incremental as streaming
from tests.core.test_runs import BASE, case, link


def lines(path, rows):
    path.mkdir(parents=True, exist_ok=True)
    (path / "rows.json").write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def numbered(**more):
    return {"id": None, "category": "övrigt", "status": "pågående", "initiators": [], "_link_flag": None, **more}


def full(pos, title, quote, ref, url="u", when="2024-01-31"):
    step = {"step_id": f"s-{title}", "instance": "council", "quote": quote, "date": when, "source": {"protocol_ref": ref, "pdf_url": url}}
    return numbered(pos=pos, title=title, initiativ_typ="motion", steps=[step])


def test_chain(spark, tmp_path):
    """gates, verify, archive, link, publish and build, each from what the one before has left."""
    t = str(tmp_path)
    lines(tmp_path / "cases", [full(0, "bike", "a new path", "§1 KF"), full(1, "bridge", "never said", "§2 KF"), full(2, "park", "trees grow", "§3 KF"), full(3, "empty", "", "§4 KF")])
    (tmp_path / "source.txt").write_text("§1 first\nWe want a new  path.\n§3 trees\ngrow tall")
    assert main(["gates", f"{t}/cases", f"{t}/source.txt", f"{t}/gated"]) == 0
    assert sorted(r.title for r in spark.read.json(f"{t}/gated/ready").collect()) == ["bike", "park"]
    review = {r.title: [c.reason for c in r.failed_checks or []] for r in spark.read.json(f"{t}/gated/needs_review").collect()}
    assert review == {"bridge": ["not found"], "empty": []}
    lines(tmp_path / "verdicts", [{"case_pos": 0, "raw": '{"decision": "publish"}'}, {"case_pos": 2, "raw": "no JSON"}])
    assert main(["verify", f"{t}/gated/ready", f"{t}/verdicts", f"{t}/checked"]) == 0
    assert [r.title for r in spark.read.json(f"{t}/checked/verified").collect()] == ["bike"]
    assert [(r.title, r.verdict.decision) for r in spark.read.json(f"{t}/checked/review").collect()] == [("park", "review")]
    (tmp_path / "raw" / "council").mkdir(parents=True)
    (tmp_path / "raw" / "council" / "p.pdf").write_bytes(b"%PDF-1")
    lines(tmp_path / "manifest", [{"pdf_url": "u", "relative_path": "council/p.pdf", "repo": "o/cold"}, {"pdf_url": "v", "relative_path": "gone.pdf", "repo": "o/cold"}])
    assert main(["archive", f"{t}/checked/verified", f"{t}/raw", f"{t}/manifest", f"{t}/archive"]) == 0
    assert spark.read.json(f"{t}/archive/archived").first().steps[0].source.archive_url == "git-pending:o/cold:council/p.pdf"
    assert spark.read.json(f"{t}/archive/hashes").count() == 1 and spark.read.json(f"{t}/archive/missing").first().pdf_url == "v"
    assert main(["publish", f"{t}/db", f"{t}/out", "r0", "now"]) == 1
    for _ in range(2):  # folding the same cases in again changes nothing
        assert main(["link", f"{t}/archive/archived", f"{t}/source.txt", f"{t}/db", f"{t}/lost"]) == 0
        got = steps.cases_at(spark, f"{t}/db").orderBy("pos").collect()
    assert [(r.id, r.title) for r in got][:1] == [("a-2024-0001", "bike")]
    assert main(["publish", f"{t}/db", f"{t}/out", "r1", "now"]) == 0 and main(["publish", f"{t}/db", f"{t}/out", "r2", "later"]) == 0
    out = Store(spark, f"{t}/out")
    log = {r.run_id: r for r in out.log("changelog", schemas.CHANGELOG).collect()}
    assert "a-2024-0001" in log["r1"].new_arenden and not log["r2"].new_arenden and log["r1"].data_hash == log["r2"].data_hash
    assert spark.read.text(out.where("hash")).first().value == log["r1"].data_hash
    (tmp_path / "page.html").write_text("<script>/*__CASES__*/</script>")
    assert main(["build", f"{t}/page.html", f"{t}/out", f"{t}/site"]) == 0
    assert list((tmp_path / "site" / "by-body").glob("body=*/year=*"))
    assert json.loads(spark.read.text(f"{t}/site/api").first().value)[0]["title"] == "bike"
    assert '"title":"bike"' in spark.read.text(f"{t}/site/index.html").first().value


def test_weekly_and_backfill(spark, tmp_path):
    """State, diagnostics and reviews are written; a meeting is seen only once it is published; a failed run is logged."""
    world, t = tmp_path / "world", str(tmp_path)
    lines(world / "bodies", [{"slug": "council", "name": "Council", "confirmed": True}, {"slug": "board", "name": "Board", "confirmed": True}, {"slug": "old", "name": "Old", "confirmed": False}])
    lines(world / "list_errors", [{"committee_slug": "board", "error": "503"}])
    lines(world / "lists", [{"committee_slug": "council", "html": link("council", "2024-01-31") + link("council", "2024-02-28") + link("council", "2023-01-15")}])
    lines(world / "seeds", [])
    url = {}
    for d in ("2024-01-31", "2023-01-15"):
        (world / "pages" / "council" / d).mkdir(parents=True)
        (world / "pages" / "council" / d / "page.html").write_text(link("council", d, "/protocol/p-1pdf"))
        url[d] = f"{BASE}/committees/council/mote-{d}/protocol/p-1pdf"
    lines(world / "texts", [{"pdf_url": u, "text": "§1 x\nWe want a new path."} for u in url.values()])
    lines(world / "answers", [{"pdf_url": u, "raw": json.dumps({"arenden": [case(f"bike {d}", "a new path", "§1 KF"), case("no", "never said", "§2 KF")]})} for d, u in url.items()])
    main(["weekly", f"{world}", f"{t}/state", BASE, "w1", "now", "1"])
    kept = Store(spark, f"{t}/state")
    seen = lambda: sorted(r.date for r in kept.rows("seen", schemas.SEEN).collect())
    assert seen() == ["2024-01-31"]
    assert [r.title for r in kept.rows("cases", steps.CASE_ROW).collect()] == ["bike 2024-01-31"]
    main(["backfill", f"{world}", f"{t}/state", BASE, "b1", "now", "council", "2023-01-01", "2023-12-31"])
    assert seen() == ["2023-01-15", "2024-01-31"]
    with pytest.raises(ValueError, match="confirmed"):
        main(["backfill", f"{world}", f"{t}/state", BASE, "b2", "now", "old", "2023-01-01", "2023-12-31"])
    log = {r.run_id: r for r in steps.run_log(spark, f"{t}/state").collect()}
    assert (log["w1"].found, log["w1"].batch, log["w1"].review, log["w1"].failure) == (3, 1, 1, None)
    assert (log["b1"].found, log["b1"].in_range, log["b1"].remaining) == (3, 1, 1) and "confirmed" in log["b2"].failure
    assert (log["w1"].capped, log["b1"].capped) == (True, False)
    assert {r.run_id for r in kept.log("needs_review", steps.REVIEW_ROW).collect()} == {"w1", "b1"}
    assert sorted((r.committee_slug, r.found, r.error) for r in kept.log("diagnostics", steps.FOUND_ROW).collect()) == [("board", 0, "503"), ("council", 3, None)]


def small_world(tmp_path, titles=("bike",)):
    world = tmp_path / "world"
    lines(world / "bodies", [{"slug": "council", "name": "Council", "confirmed": True}])
    lines(world / "lists", [{"committee_slug": "council", "html": link("council", "2024-01-31")}])
    lines(world / "seeds", [])
    (world / "pages" / "council" / "2024-01-31").mkdir(parents=True)
    (world / "pages" / "council" / "2024-01-31" / "page.html").write_text(link("council", "2024-01-31", "/protocol/p-1pdf"))
    url = f"{BASE}/committees/council/mote-2024-01-31/protocol/p-1pdf"
    lines(world / "texts", [{"pdf_url": url, "text": "§1 x\nWe want a new path."}])
    lines(world / "answers", [{"pdf_url": url, "raw": json.dumps({"arenden": [*(case(t, "a new path", "§1 KF") for t in titles), case("no", "never said", "§2 KF")]})}])
    return world


def seen_by_readers(store):
    """All that a reader of the store can see."""
    tables = {"cases": steps.CASE_ROW, "seen": schemas.SEEN}
    logs = {"changelog": schemas.CHANGELOG, "needs_review": steps.REVIEW_ROW, "errors": schemas.ERROR, "diagnostics": steps.FOUND_ROW, "runs": steps.RUN_ROW}
    found = {n: sorted(map(str, store.rows(n, k).collect())) for n, k in tables.items()} | {n: sorted(map(str, store.log(n, k).collect())) for n, k in logs.items()}
    return found | {n: (at := store.where(n)) and store.spark.read.text(at).collect() for n in ("published", "hash")}


def breaking(monkeypatch, at):
    """Let the at-th write or commit of a run fail, at odd places after it was done, else before."""
    count, real = [0], {n: getattr(Run, n) for n in ("write", "text", "commit")}

    def call(name):
        def run(self, *a):
            count[0] += 1
            if count[0] == at and (name == "commit" or at % 2 == 0):
                raise OSError(name)
            out = real[name](self, *a)
            if count[0] == at:
                raise OSError(name)
            return out

        return run

    for n in real:
        monkeypatch.setattr(Run, n, call(n))


def test_publishing_that_breaks_off_leaves_the_old_state(spark, tmp_path, monkeypatch):
    """Killed at each of its writes and at its commit: readers see the state before; the run again gives what an unbroken one gives, once."""
    lines(tmp_path / "db", [full(0, "bike", "a new path", "§1 KF") | {"id": "a-2024-0001"}])
    publish = lambda folder, run: steps.publish_step(spark, f"{tmp_path}/db", f"{tmp_path}/{folder}", run, "now")
    publish("whole", "r1")
    want, store = seen_by_readers(Store(spark, f"{tmp_path}/whole")), Store(spark, f"{tmp_path}/broken")
    assert [len(want[k]) for k in ("cases", "changelog", "published", "hash")] == [1] * 4
    empty, where = seen_by_readers(store), []
    for at in range(1, 20):
        with monkeypatch.context() as m:
            breaking(m, at)
            try:
                publish("broken", "r1")
            except OSError as e:
                where.append(str(e))
                continue
        break
    assert where.count("commit") == 1 and len(where) == 6 and seen_by_readers(store) == want != empty
    publish("broken", "r1")  # the same run again
    assert seen_by_readers(store) == want and store.committed() == ["r1"]


def test_a_weekly_run_that_breaks_off_leaves_the_old_state(spark, tmp_path, monkeypatch):
    """Killed midway and at its commit, then run to its end, then run again."""
    args = ["weekly", f"{small_world(tmp_path)}", f"{tmp_path}/state", BASE, "w1", "now"]
    store = Store(spark, f"{tmp_path}/state")
    for at in (3, 11):
        with monkeypatch.context() as m:
            breaking(m, at)
            with pytest.raises(OSError, match="commit" if at == 11 else "write"):
                main(args)
        assert store.committed() == [] and store.rows("cases", steps.CASE_ROW).count() == 0
    main(args)
    got = seen_by_readers(store)
    assert [len(got[k]) for k in ("cases", "seen", "changelog", "needs_review", "runs")] == [1] * 5
    main(args)
    assert seen_by_readers(store) == got
    assert sorted(r.failure for r in spark.read.json(f"{tmp_path}/state/failures").collect()) == ["OSError: commit", "OSError: write"]


def test_only_one_of_two_runs_commits(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    df = spark.range(3)
    one, two = store.begin("a/1"), store.begin("b")
    assert one.write(df, "t") == 3 and two.write(df.limit(1), "t") == 1
    assert store.rows("t", "id long").count() == 0
    one.commit()
    with pytest.raises(Taken):
        two.commit()
    assert store.committed() == ["a/1"] and store.rows("t", "id long").count() == 3 and store.begin("a/1") is None
    again = store.begin("b")
    again.write(df.limit(2), "t")
    again.commit()
    assert store.rows("t", "id long").count() == 2 and store.log("t", "id long").count() == 5


def test_batches_of_answers_are_linked_once(spark, tmp_path):
    """Answers in micro-batches, with a restart and a batch delivered again: the same as one batch of them all."""
    world = tmp_path / "world"
    url = lambda i: f"{BASE}/committees/council/mote-2024-01-0{i}/protocol/p-1pdf"
    texts = {1: "§1 a\nWe want a new path.", 2: "§5 b\nWe want a new path, see §1 KF.", 3: "§6 c\nWe want a new path, see §5 KF."}
    lines(world / "texts", [{"pdf_url": url(i), "text": t} for i, t in texts.items()])
    answer = lambda i, ref: {"committee_slug": "council", "date": f"2024-01-0{i}", "protocol_pdf_url": url(i), "raw": json.dumps({"arenden": [case(f"t{i}", "a new path", ref), case("no", "never said", "§9 KF")]})}
    answers = [answer(1, "§1 KF"), answer(2, "§5 KF"), answer(3, "§6 KF")]
    (world / "answers").mkdir()
    run = steps.link_batches(f"{world}", f"{tmp_path}/state", lambda n: f"at {n}")

    def drain(store, each, per_batch):
        schema = schemas.struct(steps.ANSWERED)
        streaming.drained(streaming.landed(spark, f"{world}/answers", schema, fmt="json", per_batch=per_batch), f"{tmp_path}/{store}-offsets", each)

    for i, row in enumerate(answers):
        (world / "answers" / f"{i}.json").write_text(json.dumps(row))
        drain("state", run, 1)  # a restart for each file: the offsets tell what is new
    store = Store(spark, f"{tmp_path}/state")
    assert store.committed() == ["batch-0", "batch-1", "batch-2"]
    before = seen_by_readers(store)
    run(spark.createDataFrame([tuple(answers[1].values())], steps.ANSWERED), 1)  # the second batch again
    assert seen_by_readers(store) == before
    drain("whole", steps.link_batches(f"{world}", f"{tmp_path}/whole", lambda n: "now"), 10)
    flat = lambda at: [(r.id, r.title, [s.step_id for s in r.steps]) for r in Store(spark, f"{tmp_path}/{at}").rows("cases", steps.CASE_ROW).orderBy("pos").collect()]
    assert flat("state") == flat("whole") == [("a-2024-0001", "t1", ["s-t1", "s-t2", "s-t3"])]
    assert len(before["needs_review"]) == 3 and len(before["seen"]) == 3 and len(before["changelog"]) == 3
    assert spark.read.text(store.where("hash")).first().value == spark.read.text(Store(spark, f"{tmp_path}/whole").where("hash")).first().value


def test_downloads(spark, tmp_path):
    files = spark.createDataFrame([("a", "x/1/p.pdf"), ("b", "x/2/q.pdf"), (None, "n")], "url string, relative_path string")

    def get(url):
        if url != "a":
            raise OSError(f"404 for {url}")
        return b"%PDF"

    got = {r.relative_path: (r.n_bytes, r.error) for r in fetch.downloaded(files, get, f"file://{tmp_path}/raw").collect()}
    assert got == {"x/1/p.pdf": (4, None), "x/2/q.pdf": (None, "OSError: 404 for b"), "n": (None, "OSError: 404 for None")}
    assert (tmp_path / "raw/x/1/p.pdf").read_bytes() == b"%PDF"
    assert fetch.downloaded(files.limit(0), get, f"file://{tmp_path}/raw").count() == 0


def test_extract(spark, tmp_path):
    """Each text is asked for once; failed requests and unreadable answers are rows of errors."""
    lines(tmp_path / "minutes", [{"pdf_url": u, "protocol_ref": f"§1 {u}", "date": "2024-01-31", "text": f"text of {u}"} for u in ("good", "bad", "down")])
    log = tmp_path / "asked"
    log.mkdir()

    def model(prompt):
        name = next(u for u in ("good", "bad", "down") if f"text of {u}" in prompt)
        with open(log / name, "a") as f:
            f.write("x")
        if name == "down":
            raise OSError("503")
        return json.dumps({"arenden": [case("bike", "a path", "§1 KF")]}) if name == "good" else "no JSON"

    steps.extract_step(spark, f"{tmp_path}/minutes", f"{tmp_path}/out", model)
    assert [(r.title, r.steps[0].source.pdf_url, r.steps[0].instance) for r in spark.read.json(f"{tmp_path}/out/cases").collect()] == [("bike", "good", "the-council")]
    assert {(r.pdf_url, r.error) for r in spark.read.json(f"{tmp_path}/out/errors").collect()} == {("bad", "invalid JSON"), ("down", "OSError: 503")}
    assert {r.pdf_url for r in spark.read.json(f"{tmp_path}/out/answers").collect()} == {"good", "bad"}
    assert all((log / u).read_text() == "x" for u in ("good", "bad", "down"))


def test_snapshots(spark):
    urls = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "pdf_url string")
    submit = lambda u: {"a": '{"job_id": "a1"}', "b": '{"message": "slow"}', "c": '{"job_id": "c1"}', "d": "["}[u]
    asked = {}

    def status(job):
        asked[job] = asked.get(job, 0) + 1
        return '{"status": "success", "timestamp": "2024", "original_url": "a"}' if job == "a1" and asked[job] == 3 else '{"status": "pending"}'

    got = {r.pdf_url: (r.wayback_url, r.error) for r in fetch.snapshots(urls.coalesce(1), submit, status, "https://h", attempts=4, sleep=lambda _: None).collect()}
    assert got == {"a": ("https://h/web/2024/a", None), "b": (None, "slow"), "c": (None, "still pending after 4 attempts"), "d": (None, "invalid JSON")}


def test_pdf_text():
    page = b"BT /F1 12 Tf 10 700 Td (First \\(line\\) with \\344) Tj 0 -14 Td [(sec) -20 (ond) -300 (word)] TJ <4869> Tj ET"
    plain = b"%PDF-1.4\n1 0 obj <<>> stream\n" + page + b"\nendstream endobj"
    packed = b"%PDF-1.4\n1 0 obj <<>> stream\n" + zlib.compress(page) + b"\nendstream endobj"
    assert fetch.pdf_text(plain) == fetch.pdf_text(packed) == "First (line) with ä\nsecond wordHi"
    with pytest.raises(ValueError, match="PDF"):
        fetch.pdf_text(b"<html>")
    for odd in (b"/Encoding /Identity-H", b"<< /Type /ObjStm >>", b"/Encrypt 3 0 R"):
        with pytest.raises(ValueError, match="another extractor"):
            fetch.pdf_text(plain + odd)


def test_rows_of_a_missing_table(spark, tmp_path):
    assert steps.rows(spark, f"{tmp_path}/none", "a int").count() == 0
