"""Gate, validation, archive marking, incremental selection and publication on small inputs of our own."""

import json
import random
import re
import unicodedata

import pytest
import regex
from pyspark.sql import functions as F

from docket import schemas
from docket.functions.text import normal_space
from docket.operators import archive, gates, incremental, publish, validate
from docket.plans import driver, oracle
from docket.sources import landed, providers, state
from docket.streaming import incremental as streaming


def step(quote="alpha beta", kind="decision", step_id="s1", reservations=(), notes=(), **more):
    made = {"step_id": step_id, "instance": "town_board", "type": kind, "date": "2024-01-31", "quote": quote, "decision": None, "voting": None, "reservations": [dict(parties=list(p), quote=q) for p, q in reservations], "protocol_anteckning": [dict(parties=list(p), quote=q) for p, q in notes], "source": {"protocol_ref": "§1 KF", "pdf_url": "u1", "archive_url": None, "wayback_url": None}}
    return made | more


def cases(spark, *lists):
    rows = [{"case_pos": i, "pos": i, "id": f"a-2024-{i + 1:04}", "title": f"case {i}", "initiativ_typ": "motion", "category": "övrigt", "status": "pågående", "diarienummer": None, "initiators": [], "steps": s, "_link_flag": None} for i, s in enumerate(lists)]
    return spark.createDataFrame(rows, schemas.struct(f"case_pos long, pos long, {schemas.CASE}"))


SOURCE = "Minutes.\nalpha\n beta  gamma; " + " ".join(f"w{i}" for i in range(60))


def gate(spark, df):
    source = spark.createDataFrame([(i, SOURCE) for i in range(9)], "case_pos long, text string")
    checks = gates.check(gates.quotes(df), source, ["case_pos"])
    return checks, gates.all_passed(df.select("case_pos"), checks, ["case_pos"])


def words(n):
    return " ".join(f"w{i}" for i in range(n))


@pytest.mark.parametrize("quote,kind,reason", [("alpha beta", "x", gates.FOUND), (" alpha\tbeta ", "x", gates.FOUND), ("beta alpha", "x", gates.MISSING), ("  ", "x", gates.EMPTY), (words(43), "x", gates.TOO_LONG), (words(43), "namndyttrande", gates.FOUND), (words(40), "x", gates.FOUND)])
def test_gate_reasons(spark, quote, kind, reason):
    checks, _ = gate(spark, cases(spark, [step(quote, kind)]))
    assert [r.reason for r in checks.collect()] == [reason]


def test_gate_statements_and_all_of(spark):
    long = words(54)
    df = cases(spark, [step(reservations=[(("A", "B"), long)], notes=[(("C",), "gamma")])], [step(), step("nowhere")], [], [step("")], [step(None)])
    checks, gated = gate(spark, df)
    fields = {(r.case_pos, r.field): r.passed for r in checks.collect()}
    assert fields[(0, "reservation[A+B]")] and fields[(0, "protocol_anteckning[C]")] and fields[(0, "quote")]
    got = {r.case_pos: (r.n_checks, r.passed) for r in gated.collect()}
    assert got == {0: (3, True), 1: (2, False), 2: (0, False), 3: (0, False), 4: (0, False)}
    ready, review = gates.split(gated)
    assert ready.count() == 1 and review.count() == 4


def test_gate_ignores_white_space(spark):
    rnd = random.Random(1)
    quotes = [rnd.choice([" ", "\n", " "]).join(SOURCE.split()[a : a + 5]) for a in range(0, 40, 4)]
    checks, _ = gate(spark, cases(spark, [step(q) for q in quotes]))
    assert all(r.passed for r in checks.collect())


GOOD = {"title": "t", "initiativ_typ": "motion", "steps": [{"step_id": "s", "quote": "q", "date": "2024-01-31", "voting": {"recorded": False, "note": "my own words"}, "extra": 1}]}


@pytest.mark.parametrize(
    "raw,n_cases,errors",
    [
        (json.dumps({"arenden": [GOOD]}), 1, []),
        ("```json\n" + json.dumps({"arenden": [GOOD]}) + "\n```", 1, []),
        ("{broken", 0, ["invalid JSON"]),
        (json.dumps({"arenden": [GOOD]}) + "}", 0, ["invalid JSON"]),
        ("[]", 0, ["no cases in the answer"]),
        ("null", 0, ["no cases in the answer"]),
        ('{"x": 1}', 0, ["no cases in the answer"]),
        ('{"arenden": {}}', 0, ["cases are not a list"]),
        ('{"arenden": null}', 0, ["cases are not a list"]),
        ('{"arenden": []}', 0, []),
        (json.dumps({"arenden": [1, None, GOOD]}), 1, ["not an object", "not an object"]),
        (json.dumps({"arenden": [GOOD | {"title": " "}]}), 0, ["no title"]),
        (json.dumps({"arenden": [GOOD | {"title": 5}]}), 0, ["no title"]),
        (json.dumps({"arenden": [GOOD | {"initiativ_typ": "poem"}]}), 0, ["unknown initiativ_typ"]),
        (json.dumps({"arenden": [GOOD | {"steps": []}]}), 0, ["no steps"]),
        (json.dumps({"arenden": [GOOD | {"steps": [GOOD["steps"][0], {"quote": "q", "date": "31 January"}]}]}), 0, ["bad date", "case left out: bad steps"]),
        (json.dumps({"arenden": [GOOD | {"steps": ["x", {"quote": "", "date": "2024-01-01"}]}, GOOD]}), 1, ["case left out: bad steps", "no quote", "not an object"]),
        (json.dumps({"arenden": [GOOD | {"steps": [{"quote": "q", "date": "2026-99-99"}]}]}), 1, []),
    ],
)
def test_validation(spark, raw, n_cases, errors):
    got, wrong = validate.parse_cases(spark.createDataFrame([("u", raw)], "pdf_url string, raw string"), ["pdf_url"])
    assert got.count() == n_cases
    assert sorted(r.error for r in wrong.collect()) == sorted(errors)


def test_defaults_and_fixed_note(spark):
    more = GOOD | {"category": "rymden", "status": "kanske", "diarienummer": 7, "initiators": "nobody"}
    df = spark.createDataFrame([("u", json.dumps({"arenden": [more, GOOD | {"category": "ekonomi", "status": "avgjort", "diarienummer": "1/24", "initiators": [{"name": "N", "party": "P"}]}]}))], "pdf_url string, raw string")
    a, b = validate.parse_cases(df, ["pdf_url"])[0].orderBy("case_pos").collect()
    assert (a.category, a.status, a.diarienummer, a.initiators) == ("övrigt", "pågående", None, [])
    assert (b.category, b.status, b.diarienummer, b.initiators[0].party) == ("ekonomi", "avgjort", "1/24", "P")
    assert a.steps[0].voting.note == schemas.VOTES_NOT_RECORDED and a.steps[0].source is None
    stamped = validate.stamped(validate.parse_cases(df, ["pdf_url"])[0], F.col("pdf_url")).first()
    assert stamped.steps[0].source.pdf_url == "u"


def test_slugs(spark):
    assert validate.with_slugs(cases(spark, [step()])).first().steps[0].instance == "town-board"


@pytest.mark.parametrize("raw,decision", [('{"decision": "publish"}', "publish"), ('```json\n{"decision": "reject"}```', "reject"), ("x", "review"), ('{"decision": "sure"}', "review"), ("[]", "review"), ('{"decision": 1}', "review"), (None, "review")])
def test_verdicts(spark, raw, decision):
    v = spark.createDataFrame([(raw,)], "raw string").select(validate.parsed_verdict(F.col("raw")).alias("v")).first().v
    assert v.decision == decision


@pytest.mark.parametrize("passed,decision,out", [(True, "publish", "publish"), (True, "review", "needs_review"), (False, "publish", "needs_review"), (None, None, "needs_review")])
def test_reconcile(spark, passed, decision, out):
    df = spark.createDataFrame([(passed, decision)], "p boolean, d string")
    assert df.select(validate.reconciled(F.col("p"), F.col("d")).alias("x")).first().x == out


def files(spark):
    rows = [("u1", "old/a.pdf", "o/cold", 0, b"one"), ("u1", "new/a.pdf", "o/cold", 1, b"two"), ("u9", "b.pdf", "o/cold", 2, b"%PDF three")]
    return spark.createDataFrame(rows, schemas.struct(schemas.RAW_FILE))


def test_archive_marks(spark):
    df = cases(spark, [step(), step(step_id="s2", source={"protocol_ref": "§1 KF", "pdf_url": "elsewhere", "archive_url": "kept", "wayback_url": None})], [])
    got = archive.marked(df, files(spark)).orderBy("pos").collect()
    assert [s.source.archive_url for s in got[0].steps] == ["git-pending:o/cold:new/a.pdf", "kept"] and got[1].steps == []
    snaps = spark.createDataFrame([("u1", "w1")], "pdf_url string, wayback_url string")
    assert [s.source.wayback_url for s in archive.with_snapshots(df, snaps).orderBy("pos").first().steps] == ["w1", None]
    linked = archive.with_permalinks(archive.marked(df, files(spark)), "https://h", "o/main", "a", "o/cold", "b").orderBy("pos").first()
    assert linked.steps[0].source.archive_url == "https://h/o/cold/blob/b/new/a.pdf"
    hashes = {r.relative_path: r.sha256 for r in archive.file_hashes(files(spark)).collect()}
    assert len(hashes) == 3 and hashes["old/a.pdf"] == "7692c3ad3540bb803c020b3aee66cd8887123234ea0c6e7143c0add73ff431ed"
    assert landed.real_pdfs(files(spark)).count() == 1


def test_incremental(spark):
    refs = spark.createDataFrame([("a", f"2024-01-{d:02}") for d in range(1, 21)] + [("b", "2024-01-01")], schemas.SEEN)
    seen = spark.createDataFrame([("a", "2024-01-02"), ("a", "2024-01-02"), ("c", "2024-01-01")], schemas.SEEN)
    todo = incremental.unseen(refs, seen)
    assert todo.count() == 20
    assert [r.date for r in incremental.newest(todo, "date", ["committee_slug"], 2).collect()] == ["2024-01-20", "2024-01-19"]
    assert [(r.committee_slug, r.date) for r in incremental.oldest(todo, "date", ["committee_slug"], 2).collect()] == [("a", "2024-01-01"), ("b", "2024-01-01")]
    assert incremental.in_range(refs, "2024-01-05", "2024-01-07").count() == 3
    funnel = incremental.funnel(refs, seen, F.col("date").between("2024-01-01", "2024-01-03")).first()
    assert tuple(funnel) == (21, 4, 1, 3)
    once = incremental.mark_seen(seen, refs.where("committee_slug = 'b'"))
    rows = {r.committee_slug: r.dates for r in once.collect()}
    assert rows == {"a": ["2024-01-02"], "b": ["2024-01-01"], "c": ["2024-01-01"]}
    flat = once.select("committee_slug", F.explode("dates").alias("date"))
    assert {r.committee_slug: r.dates for r in incremental.mark_seen(flat, flat).collect()} == rows


def shuffled(value, rnd):
    if isinstance(value, dict):
        items = [(k, shuffled(v, rnd)) for k, v in value.items()]
        rnd.shuffle(items)
        return dict(items)
    return [shuffled(v, rnd) for v in value] if isinstance(value, list) else value


def test_hash_ignores_key_order(spark):
    rnd = random.Random(3)
    value = {"b": [3, 1, {"z": None, "a": "å"}], "a": {"y": 1, "x": [], "w": {}}, "c": "<\"\\>"}
    texts = [json.dumps(shuffled(value, rnd), ensure_ascii=bool(i % 2)) for i in range(6)] + [json.dumps(value | {"b": [1, 3]})]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    hashes = [r[0] for r in df.select(publish.data_hash(F.col("t"))).collect()]
    assert len(set(hashes[:6])) == 1 and hashes[6] != hashes[0]
    canon = df.select(publish.canonical(F.col("t"))).first()[0]
    assert canon == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_publication(spark):
    before = cases(spark, [step()], [step()], [step()]).where("pos < 3")
    now = cases(spark, [step(), step(step_id="s2"), step(step_id="s2")], [step()], [], [step()])
    diff = {r.id: (r.is_new, r.new_step_ids) for r in publish.difference(before, now).collect()}
    assert diff == {"a-2024-0001": (False, ["s2", "s2"]), "a-2024-0004": (True, [])}
    row = publish.changelog(before, now, "run", "now").first()
    assert (row.arende_count, row.new_arenden, [tuple(u) for u in row.updated_arenden]) == (4, ["a-2024-0004"], [("a-2024-0001", ["s2", "s2"])])
    again = publish.changelog(now, now, "run", "now").first()
    assert again.data_hash == row.data_hash and again.new_arenden == [] and again.updated_arenden == []
    page = publish.render(f"<script>x = {publish.PLACEHOLDER}; {publish.PLACEHOLDER}</script>", cases(spark, [step("</script>")]))
    assert page.count(publish.PLACEHOLDER) == 1 and "<\\/script>" in page
    with pytest.raises(ValueError, match="placeholder|has no"):
        publish.render("<html>", now)


def test_views(spark):
    df = cases(spark, [step(reservations=[(("A",), "q")])], [step("Gamma ray", instance="council")], [])
    assert publish.by_body(df, "council").count() == 1
    assert publish.by_party(df, "A").count() == 1
    assert publish.search(df, "GAMMA").count() == 1 and publish.search(df, "case", slug="town_board").count() == 1
    assert publish.search(df, "case", status="avgjort").count() == 0
    shown = spark.createDataFrame([("git-pending:x",), ("https://x",)], "u string").select(publish.shown_link(F.col("u")).alias("u"))
    assert [r.u for r in shown.collect()] == [None, "https://x"]


def test_state_and_landed(spark, tmp_path):
    assert state.load_seen(spark, f"{tmp_path}/none.json").count() == 0
    (tmp_path / "seen.json").write_text('{"a": ["2024-01-01", "2024-01-02"], "b": []}')
    assert state.load_seen(spark, f"{tmp_path}/seen.json").count() == 2
    (tmp_path / "bad.json").write_text("{")
    assert state.load_seen(spark, f"{tmp_path}/bad.json").count() == 0
    assert state.load_cases(spark, f"{tmp_path}/none.json").count() == 0
    df = cases(spark, [step()], [])
    (tmp_path / "cases.json").write_text(publish.database_json(df.drop("case_pos")).first().json)
    back = state.load_cases(spark, f"{tmp_path}/cases.json").orderBy("pos").collect()
    assert [r.title for r in back] == ["case 0", "case 1"] and back[0].steps[0].quote == "alpha beta"
    folder = tmp_path / "raw" / "council" / "2024-01-31"
    folder.mkdir(parents=True)
    (folder / "page.html").write_text("<p>å")
    (folder / "p.pdf").write_bytes(b"%PDF")
    assert [tuple(r) for r in landed.pages(spark, f"{tmp_path}/raw").collect()] == [("council", "2024-01-31", "<p>å")]
    listed = spark.createDataFrame([("u1", "council/2024-01-31/p.pdf", "r"), ("u2", "council/missing.pdf", "r")], "pdf_url string, relative_path string, repo string")
    found, missing = landed.raw_files(spark, f"{tmp_path}/raw", listed)
    assert [r.pdf_url for r in found.collect()] == ["u1"] and [r.pdf_url for r in missing.collect()] == ["u2"]
    landed.write_manifest(listed, f"{tmp_path}/manifest")
    landed.write_manifest(listed, f"{tmp_path}/manifest")
    assert landed.manifest(spark, f"{tmp_path}/manifest").count() == 4


def test_providers(spark):
    def answer(request):
        if request == "bad":
            raise OSError("down")
        return request.upper()

    df = spark.createDataFrame([("x",), ("bad",)], "q string")
    assert sorted(tuple(r) for r in providers.asked(df, "q", answer).collect()) == [("bad", None, "OSError: down"), ("x", "X", None)]
    recorded = spark.createDataFrame([("x", "y")], "q string, raw string")
    assert sorted(tuple(r) for r in providers.replayed(df, recorded, ["q"]).collect()) == [("bad", None, "no recorded answer"), ("x", "y", None)]
    texts = {r.pdf_url: r.text for r in providers.texts(files(spark), lambda b: b[:4].decode().strip("%")).collect()}
    assert texts["u9"] == "PDF"
    prompt = df.select(providers.extraction_prompt(F.col("q"), F.lit("§1"), F.lit("2024-01-31"), schemas.INITIATIVE_TYPES, schemas.CATEGORIES).alias("p")).first().p
    assert "motion" in prompt and prompt.endswith("x")
    assert "Source:\nx" in df.select(providers.verification_prompt(F.lit("{}"), F.col("q")).alias("p")).first().p


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-01"), ("b", "2024-01-02")], schemas.SEEN)
    for i in range(3):
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda: streaming.drained(streaming.landed(spark, f"{tmp_path}/in", schemas.SEEN, per_batch=1), f"{tmp_path}/checkpoint", streaming.seen_store(f"{tmp_path}/seen"))
    run()
    want = {"a": ["2024-01-01"], "b": ["2024-01-02"]}
    assert {r.committee_slug: r.dates for r in streaming.load_seen_store(spark, f"{tmp_path}/seen").collect()} == want
    spark.createDataFrame([("b", "2024-01-01")], schemas.SEEN).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert {r.committee_slug: r.dates for r in streaming.load_seen_store(spark, f"{tmp_path}/seen").collect()} == want | {"b": ["2024-01-01", "2024-01-02"]}
    assert normal_space is not None


def test_passages_at_every_position(spark):
    """Candidates lose no passage that a text contains: within sentences, after any mark, across words' parts, short ones."""
    rnd = random.Random(8)
    passages = ["the quick brown fox jumps over it", "No. Short start of a passage", "one  two\nthree", "ab cd", "xyz", "never there at all, this one", " ", None]
    texts = [None, "", "xyz"]
    for _ in range(80):
        parts = ["".join(rnd.choice("abcxyz") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(0, 30))]
        for p in rnd.sample(passages[:5], rnd.randint(0, 3)):
            parts.insert(rnd.randint(0, len(parts)), rnd.choice(["", "Hm! ", "what? ", "x"]) + p + rnd.choice(["", "y", "!"]))
        texts.append(rnd.choice([" ", "\n", ". "]).join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    quotes = spark.createDataFrame(list(enumerate(passages)), "item_id long, quote string")
    found = gates.check(gates.candidates(quotes, docs, ["doc_id"]).withColumn("word_limit", F.lit(None).cast("int")), docs, ["doc_id"])
    got = sorted((r.doc_id, r.item_id) for r in found.where("passed").collect())
    normal = lambda t: " ".join((t or "").split())
    want = sorted((i, k) for i, t in enumerate(texts) for k, p in enumerate(passages) if normal(p) and normal(p) in normal(t))
    assert got == want and len(want) > 80


def test_whole_verbatim_checks(spark):
    """Every containment of a benchmark passage and every piece of each text, on the smallest tables."""
    d = "/root/testdata/sf0.001"
    rows = driver.verbatim_checks(spark, d).collect()
    docs, bench = ([(r[0], r[1]) for r in spark.read.parquet(f"{d}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    normal = lambda t: " ".join((t or "").split())
    want = sorted((i, f"passage {k}") for i, t in docs for k, p in bench if normal(p) and normal(p) in normal(t))
    assert sorted((r.doc_id, r.field) for r in rows if r.field.startswith("passage")) == want and want
    assert sum(r.field.startswith("own") for r in rows) == sum(max(1, -(-len(t or "") // 120)) for _, t in docs)


def test_title_norm_takes_whole_texts(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}

    def plain(t, marks=" "):
        t = regex.sub(r"\p{Mn}+", marks, unicodedata.normalize("NFKD", t.lower()))
        return " ".join(regex.sub(r"[^\p{L}\p{N}]", " ", t).split())

    rows = driver.title_norm_nfkd(spark, d).collect()
    assert len(rows) == len(texts) and sum("\n" in (t or "") for t in texts.values()) > 100
    for r in rows:
        t = texts[r.doc_id]
        assert (r.title, r.title_without_marks) == ((plain(t), plain(t, "")) if t is not None else (None, None)), r.doc_id


def test_link_decision_grows_with_pages(spark):
    """Keys and references of every page, against a plain loop."""
    d = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{d}/pages.parquet").select("page_id", "html")
    tokens = {r.page_id: r.tokens for r in driver._titles(spark, d).collect()}
    links = {r.page_id: {m[1].lower() for u in re.findall('href="([^"]*)"', r.html or "") if (m := re.search(r"([^/?#]+)/?(?:[?#].*)?$", u))} for r in pages.collect()}
    want = {}
    for k in tokens:
        by_key = [c for c, t in tokens.items() if c < k and t and t[0] in links[k]]
        x = set(tokens[k] or [])
        scored = [(-len(x & set(t)) / len(x | set(t)), c) for c, t in tokens.items() if c < k and t and x]
        best = min((p for p in scored if p[0] <= -0.6), default=None)
        want[k] = ("paragraph_ref", min(by_key)) if by_key else ("fuzzy_title", best[1]) if best else ("none", None)
    assert {r.page_id: (r.kind, r.case) for r in driver.link_decision(spark, d).collect()} == want
    met = [c for kind, c in want.values() if kind == "paragraph_ref"]
    assert len(set(met)) > 5 and len(met) > 10


def _far_orders(spark, path):
    """Orders at positions up to 400 million, and their lines."""
    import duckdb

    con = duckdb.connect()
    con.execute("create table orders as select k::bigint o_orderkey, 1::bigint o_custkey, 'F' o_orderstatus, timestamp '1995-01-01' + (k % 3) * interval 1 year o_orderdate, '1-URGENT' o_orderpriority from (values (1), (5), (5000000), (70000000), (400000000)) v(k)")
    con.execute("create table lineitem as select o_orderkey l_orderkey, n::integer l_linenumber, 7::bigint l_partkey, 'N' l_returnflag, o_orderdate + n * interval 100 day l_shipdate from orders, range(1, 4) r(n)")
    for t in ("orders", "lineitem"):
        con.execute(f"copy {t} to '{path}/{t}.parquet' (format parquet)")
    return con


def test_hash_tree_of_far_positions_equals_its_sql(spark, tmp_path):
    """Beyond 4 million positions the tree has as many levels as the SQL, which is three."""
    con = _far_orders(spark, tmp_path)
    want = con.execute("select level, node, hash, n from (" + oracle.ORACLE["hash_tree"] + ")").fetchall()
    got = driver.hash_tree(spark, str(tmp_path)).select("level", "node", "hash", "n").collect()
    assert max(r.level for r in got) == 2
    assert sorted(map(tuple, got)) == sorted(want)


def test_document_hash_is_the_documents(spark, tmp_path):
    """The streamed hash is that of the whole document, also where there is no case; the entry holds no list of cases."""
    con = _far_orders(spark, tmp_path)
    cases = driver._cases(spark, str(tmp_path), None)
    for some in (cases, cases.where("false")):
        want = publish.database_json(some).select(F.sha2("json", 256), "n").first()
        assert tuple(publish.document_hash(some).first()) == tuple(want)
    entry = driver.changelog_entry(spark, str(tmp_path))
    assert tuple(entry.select("run_id", "arende_count", "n_new", "n_updated", "data_hash").first()) == con.execute(oracle.ORACLE["changelog_entry"]).fetchone()
    assert "collect_list(CASE" not in entry._jdf.queryExecution().optimizedPlan().toString()


def test_answers_are_parsed_once_for_all_errors(spark):
    """Cases and errors are one pass over the answers each, and a mixed answer still gives all of its errors."""
    raw = '{"arenden": [{"title": "t", "initiativ_typ": "motion", "steps": [{"quote": "q", "date": "2024-01-31"}]}, 5, {"title": 3, "initiativ_typ": "motion"}, {"title": "b", "initiativ_typ": "motion", "steps": [[], {"quote": " ", "date": "2024-01-01"}, {"quote": "q", "date": 1}]}]}'
    df = spark.createDataFrame([(1, raw), (2, '{"arenden": null}'), (3, "[]"), (4, '{"arenden": []}'), (5, "{")], "k int, raw string")
    cases, errors = validate.parse_cases(df, ["k"])
    assert [tuple(r) for r in cases.select("k", "case_pos", "title").collect()] == [(1, 0, "t")]
    want = [(1, 1, None, "not an object"), (1, 2, None, "no title"), (1, 3, 0, "not an object"), (1, 3, 1, "no quote"), (1, 3, 2, "bad date"), (1, 3, None, "case left out: bad steps"), (2, None, None, "cases are not a list"), (3, None, None, "no cases in the answer"), (5, None, None, "invalid JSON")]
    assert sorted(map(tuple, errors.collect()), key=str) == sorted(want, key=str)
    assert errors._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


@pytest.mark.parametrize("query", ["range_diff", "view_search_indexed"])
def test_cases_are_made_once(spark, query):
    """What compares or searches cases reads those that the hashes or the index were made of, and doesn't make them again."""
    assert "l_orderkey" not in getattr(driver, query)(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
