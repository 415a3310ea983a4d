"""Quotations by places of their word runs, against plain containment."""

import random

from pyspark.sql import functions as F

from docket.operators import gates


def normal(t):
    return " ".join(t.split())


def reasons(spark, texts, quotes, limit=None):
    """{(doc, quote): reason} by check(), and by plain containment."""
    s = spark.createDataFrame(list(texts.items()), "doc int, text string")
    q = spark.createDataFrame([(d, q, limit) for d, q in quotes], "doc int, quote string, word_limit int")
    got = {(r.doc, r.quote): r.reason for r in gates.check(q, s, ["doc"]).collect()}
    want = {}
    for d, x in quotes:
        m = normal(x)
        want[d, x] = "empty" if not m else "too long" if limit and len(m.split()) > limit else "verified" if m in normal(texts.get(d) or "") else "not found"
    return got, want


def test_all_reasons_at_any_place(spark):
    """Pieces cut anywhere, altered ones, ones of other texts, short and very long ones."""
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["åäö", "b", "cc"]
    texts = {d: "  ".join(rnd.choice(vocabulary) for _ in range(n)) for d, n in enumerate([0, 1, 2, 3, 5, 40, 700, 1500])} | {8: None, 9: "x"}
    quotes = []
    for d in (1, 2, 3, 4, 5, 6, 7):
        for _ in range(40):
            t = texts[d]
            a = rnd.randrange(len(t))
            piece = t[a : a + rnd.choice([1, 2, 5, 9, 14, 20, 60, 300, 2500])]
            middle = len(piece) // 2
            quotes += [(d, piece), (d, piece[:middle] + rnd.choice(["Q", " not ", "w1"]) + piece[middle:]), ((d + 1) % 9, piece)]
    quotes += [(77, "no source"), (8, "null source"), (0, "empty source"), (5, " \t "), (6, texts[6]), (7, texts[7]), (7, texts[7] + " more")]
    quotes = sorted(set(quotes))
    for limit in (None, 30):
        got, want = reasons(spark, texts, quotes, limit)
        assert got == want
    assert {*want.values()} == {"empty", "too long", "verified", "not found"}


def test_repeated_runs(spark):
    """A run with more places than are tried: the whole source decides."""
    texts = {1: "a b c d e f " * 60 + "a b c d e X end", 2: "a " * 300}
    quotes = [(1, "b c d e X"), (1, "a b c d e Y"), (1, "e f a b c d"), (2, "a a a a a a"), (2, "a a a b a a")]
    got, want = reasons(spark, texts, quotes)
    assert got == want and [*want.values()].count("verified") == 3


def test_candidates(spark):
    """Passages of any length meet the texts that hold them; no text is compared with all passages."""
    texts = {1: "one two three four five six seven", 2: "xone two three fourx", 3: "öl å", 4: "", 5: None}
    passages = ["ne two three fou", "two three four five", "two", "öl å", "å", "ve six", "n", "zz", " ", "o three", "three four five six sev"]
    s = spark.createDataFrame(list(texts.items()), "doc int, text string")
    p = spark.createDataFrame([(x,) for x in passages], "quote string")
    got = {(r.doc, r.quote) for r in gates.candidates(p, s, ["doc"]).collect()}
    must = {(d, x) for d, t in texts.items() for x in passages if t and x.strip() and x in t}
    assert must <= got
    plan = gates.candidates(p, s, ["doc"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert gates.candidates(p.limit(0), s, ["doc"]).count() == gates.candidates(p.where(F.trim("quote") == ""), s, ["doc"]).count() == 0


def test_texts_are_dealt_out_once(spark):
    """Texts and quotations go through one shuffle each, by their keys; neither they nor the words' runs are shuffled or sorted again."""
    sources = spark.range(50).selectExpr("cast(id as int) doc", "concat_ws(' ', transform(sequence(1, 300), i -> concat('w', i * id))) text")
    quotes = sources.selectExpr("doc", "explode(regexp_extract_all(text, '.{1,90}', 0)) _quote").selectExpr("doc", "trim(_quote) _quote")
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with gates.dealt_alike(spark):
            found = gates.located(quotes, gates.normalised(sources, ["doc"]), ["doc"])
            assert found.count() == quotes.distinct().count()
            plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert shuffles and all("REPARTITION_BY_COL" in line and "_quote" not in line and "h#" not in line for line in shuffles), shuffles
    assert "SortMergeJoin" not in plan and "Nested" not in plan
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before


def test_repeated_quotations_and_null_keys(spark):
    """Quotations that are there twice, with other spaces between their words, or without a key, are rows each."""
    s = spark.createDataFrame([(1, "a b c d e f g"), (None, "a b c d e f g")], "doc int, text string")
    rows = [(1, "b c d e f"), (1, "b c d e f"), (1, "b  c\td e f"), (1, "b c d X f"), (1, "g"), (1, "g"), (None, "b c d e f"), (1, " "), (1, None)]
    q = spark.createDataFrame([(i, *r, 5) for i, r in enumerate(rows)], "i int, doc int, quote string, word_limit int")
    got = [r.reason for r in gates.check(q, s, ["doc"]).orderBy("i").collect()]
    assert got == ["verified"] * 3 + ["not found"] + ["verified"] * 2 + ["not found", "empty", "empty"]
