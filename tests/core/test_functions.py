"""Scalar functions, links, references and archive messages."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docket.functions import archive, links, refs, text

BASE = "https://portal.example"


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize("raw,normal", [("  a \n\t b  ", "a b"), ("a b﻿", "a b"), ("a\u0085b", "a\u0085b"), ("", ""), (" x　y", "x y")])
def test_normal_space(spark, raw, normal):
    assert one(spark, text.normal_space(F.col("t")), t=raw) == normal


def test_words(spark):
    assert one(spark, text.word_count(text.normal_space(F.col("t"))), t=" one  two\nthree ") == 3
    assert one(spark, text.word_count(text.normal_space(F.col("t"))), t=" ") == 1


def test_titles(spark):
    assert one(spark, text.normal_title(F.col("t")), t="Gällande: §4 Ångfärja!") == "ga llande 4 a ngfa rja"
    assert one(spark, text.normal_title(F.col("t"), keep_marks_apart=False), t="Gällande: §4 Ångfärja!") == "gallande 4 angfarja"
    assert one(spark, text.title_tokens(F.col("t")), t="motion om cykel och cykel i park") == ["cykel", "park"]
    same = text.jaccard(F.split(F.col("a"), " "), F.split(F.col("b"), " "))
    assert one(spark, same, a="x y z", b="y z w") == 0.5
    assert one(spark, text.jaccard(F.array().cast("array<string>"), F.split(F.col("b"), " ")), b="y") == 0.0


@pytest.mark.parametrize("raw,out", [("```json\n{}\n```", "{}"), ("```JSON {}``` ", "{}"), ("{} ", "{}"), ("x```json", "x```json")])
def test_fences(spark, raw, out):
    assert one(spark, text.without_fences(F.col("t")), t=raw).strip() == out


@pytest.mark.parametrize("slug,name", [("report-pdf", "report-"), ("a-pdf-123", "a--123"), ("a?x=1", "a"), ("b" * 200, "b" * 150), ("plainpdf", "plain")])
def test_filenames(spark, slug, name):
    assert one(spark, text.safe_filename(F.col("t")), t=slug) == name


@pytest.mark.parametrize("raw,good", [('{"a": 1}', True), ('{"a": 1}}', False), ('{"a": 1}]', False), ("1,2", False), ("", False), ('  "x" ', True), ("[1, {}]", True), ("1],[2", False)])
def test_strict_json(spark, raw, good):
    assert one(spark, text.strict_json(F.col("t")).isNotNull(), t=raw) is good


def test_inline_script(spark):
    assert one(spark, text.inline_script(F.col("t")), t='"</script> </SCRIPT   "') == '"<\\/script> <\\/SCRIPT \\u2028\\u2029"'


def test_meeting_refs(spark):
    html = f"""<a href="{BASE}/committees/council/mote-2024-01-31"> <a href='/committees/council/mote-2024-02-28'>
    <a href="/committees/council/mote-2024-01-31"> <a href="/committees/board/mote-2024-03-01"> <a href="/committees/council/mote-2024-04-01/agenda"> mote-2024-05-01x"""
    got = links.meeting_refs(spark.createDataFrame([(html,)], "html string"), "council", BASE).orderBy("pos").collect()
    assert [(r.date, r.meeting_url) for r in got] == [(d, f"{BASE}/committees/council/mote-{d}") for d in ("2024-01-31", "2024-02-28")]


@pytest.mark.parametrize("path,found", [("protocol/p-kf-2024pdf?downloadMode=open", True), ("protocol/p-123pdf-605?downloadMode=open", True), ("PROTOCOL/p-1PDF", True), ("agenda/apdf", False)])
def test_protocol_url(spark, path, found):
    for host in ("", BASE):
        link = f"{host}/committees/council/mote-2024-01-31/{path}"
        got = one(spark, links.protocol_url(BASE, F.lit("council"), F.lit("2024-01-31"), F.col("t")), t=f"<a href='{link}'><a href='{link}2'>")
        assert got == (f"{BASE}/committees/council/mote-2024-01-31/{path}" if found else None)


@pytest.mark.parametrize(
    "page,link",
    [
        ('<a href="{}pdf?downloadMode=open#page=2">', "{}pdf?downloadMode=open"),
        ('<a href="{}pdf?downloadMode=open&amp;x=1">', "{}pdf?downloadMode=open"),
        ('<a href="{}pdf-9?x=1&amp;downloadMode=open">', "{}pdf-9?downloadMode=open"),
        ('<a href="{}pdf#downloadMode=open">', "{}pdf"),
        ('<a href="{}pdf?lang=sv">', "{}pdf"),
        ("<meta content='0;url={}pdf?downloadMode=open'>", "{}pdf?downloadMode=open"),
        ("<a href={}pdf>", "{}pdf"),
        ("[minutes]({}pdf?downloadMode=open)", "{}pdf?downloadMode=open"),
        ("<a href='javascript:void(0);'>", None),
        ('<a href="{}docx">', None),
        ('<a href="https://other.example{}pdf">', None),
    ],
)
def test_forms_of_links_to_minutes(spark, page, link):
    path = "/committees/council/mote-2024-01-31/protocol/p-1"
    got = one(spark, links.protocol_url(BASE, F.lit("council"), F.lit("2024-01-31"), F.col("t")), t=page.format(path))
    assert got == (link and BASE + link.format(path))


def test_forms_of_links_to_meetings(spark):
    at = "/committees/council/mote-2024-0"
    html = f"""<a href="{at}1-01?x=1&amp;y=2"><a href="{at}2-01#top"> url={BASE}{at}3-01 "{at}4-01-x" "{at}5-01/agenda" "{at}6-010" "{at}7-01." """
    got = links.meeting_refs(spark.createDataFrame([(html,)], "html string"), "council", BASE).orderBy("pos").collect()
    assert [r.date for r in got] == ["2024-01-01", "2024-02-01", "2024-03-01", "2024-07-01"]


def test_attachments(spark):
    a = "/welcome-sv/namnder-styrelser/x/agenda/plan-apdf-7?downloadMode=open"
    html = f"""'{a}' "{BASE}{a}" "{a.replace('plan-apdf-7', 'bpdf')}" """
    got = links.attachments(spark.createDataFrame([(1, html)], "k int, html string"), BASE, ["k"]).orderBy("pos").collect()
    assert [(r.url, r.filename) for r in got] == [(BASE + a, "plan-a-7.pdf"), (BASE + a.replace("plan-apdf-7", "bpdf"), "b.pdf")]


def test_paths_and_seed(spark):
    got = one(spark, links.local_paths(F.lit("data"), F.col("s"), F.lit("2024-01-31")), s="council")
    assert tuple(got) == ("data/council/2024-01-31", "data/council/2024-01-31/protokoll.pdf", "data/council/2024-01-31/bilagor")
    steps = "array<struct<source:struct<pdf_url:string>>>"
    rows = [(0, [((None,),)]), (1, [((f"{BASE}/committees/board/mote-2024-01-01/x",),), ((f"{BASE}/committees/council/mote-2024-02-02/x",),)])]
    cases = spark.createDataFrame(rows, f"pos int, steps {steps}")
    assert links.seed_url(cases, BASE, "council").first().meeting_url == f"{BASE}/committees/council/mote-2024-02-02"
    assert links.seed_url(cases, BASE, "none").count() == 0


@pytest.mark.parametrize("t,keys", [("se §225 KF och § 2 VON", ["225|KF", "2|VON"]), ("§225/2025 KF, § 225 KF", ["225|KF"]), ("§1 KSAU", ["1|KSAU"]), ("§1 XX §2 KFX § KF", []), ("§7 ÖFN.", ["7|ÖFN"]), ("", [])])
def test_refs(spark, t, keys):
    assert one(spark, refs.ref_keys(F.col("t")), t=t) == keys


@pytest.mark.parametrize("t,key", [("§44 KF 2026-02-25", "44|KF"), ("§ 7 TEKNISKA-NAMNDEN", "7|TEKNISKA"), ("44 KF", None), ("§44 kf", None)])
def test_own_key(spark, t, key):
    assert one(spark, refs.paragraph_key(F.col("t")), t=t) == key


def test_sections(spark):
    minutes = "head\n§ 1 first\nbody §9 KF\n§2 second §8 KF\n§ 3 third"
    own = lambda t, r: one(spark, refs.own_section(F.col("t"), F.array(*map(F.lit, r))), t=t)
    assert own(minutes, ["§2 KF"]) == "§2 second §8 KF\n"
    assert own(minutes, ["§1 KF", "§77 KF"]) == "§ 1 first\nbody §9 KF\n"
    assert own(minutes, ["§1 KF", "§3 KF"]) == "§ 3 third"
    assert own(minutes, ["§77 KF", "none"]) == ""
    assert own("no headers §8 KF", ["§1 KF"]) == "no headers §8 KF"


def test_markers(spark):
    marker = one(spark, archive.pending_marker(F.lit("a:b/c.pdf"), F.col("r")), r="o/r")
    assert marker == "git-pending:o/r:a:b/c.pdf"
    assert tuple(one(spark, archive.parse_marker(F.col("m")), m=marker)) == ("o/r", "a:b/c.pdf")
    assert one(spark, archive.parse_marker(F.col("m")), m="git-pending:data/x.pdf") is None
    assert tuple(one(spark, archive.parse_marker(F.col("m"), F.lit("main/r")), m="git-pending:data/x.pdf")) == ("main/r", "data/x.pdf")
    assert one(spark, archive.is_pending(F.col("m")), m="https://x") is False
    fill = lambda m, sha="bbb": one(spark, archive.filled(F.col("m"), "https://h", "o/main", "aaa", "o/cold", sha), m=m)
    assert fill("git-pending:o/main:p") == "https://h/o/main/blob/aaa/p"
    assert fill("git-pending:o/cold:p") == "https://h/o/cold/blob/bbb/p"
    assert fill("git-pending:o/cold:p", None) == "git-pending:o/cold:p"
    assert fill("git-pending:o/other:p") == "git-pending:o/other:p"
    assert fill("https://x") == "https://x"


@given(repo=st.from_regex(r"[a-z]{1,8}/[a-z]{1,8}", fullmatch=True), path=st.from_regex(r"[a-z/:.]{0,20}", fullmatch=True))
@settings(max_examples=15, deadline=None)
def test_marker_round_trip(spark, repo, path):
    m = archive.parse_marker(archive.pending_marker(F.col("p"), F.col("r")))
    assert tuple(one(spark, m, p=path, r=repo)) == (repo, path)


def test_messages(spark):
    status = lambda t: tuple(one(spark, archive.status_response(F.col("t"), "https://a"), t=t))
    assert status('{"status": "success", "timestamp": "20240131", "original_url": "https://x"}') == ("success", "https://a/web/20240131/https://x", None)
    assert status('{"status": "pending"}') == ("pending", None, None)
    assert status('{"status": "success"}')[0] == "error"
    assert status('{"status": "error", "message": "m"}') == ("error", None, "m")
    assert status("{")[0] == "error" and status('{"status": "odd"}')[2] == "unknown status: odd"
    submit = lambda t: tuple(one(spark, archive.submit_response(F.col("t")), t=t))
    assert submit('{"job_id": "j"}') == ("j", None)
    assert submit('{"message": "m"}') == (None, "m")
    assert submit('{"job_id": ""}') == (None, "neither job_id nor message")
    assert submit("x")[1] == "invalid JSON"
    assert one(spark, archive.auth_header(F.lit("a"), F.col("s")), s="b") == "LOW a:b"
    assert one(spark, archive.submit_body(F.col("u")), u="https://x/å b") == "url=https%3A%2F%2Fx%2F%C3%A5+b&capture_all=1"
