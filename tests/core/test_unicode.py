"""The decomposition against Python's own, for every code point and for marks in any order."""

import random
import sys
import unicodedata

from pyspark.sql import functions as F

from docket.functions import text
from docket.functions.unicode import nfkd


def test_every_code_point(spark):
    """64 characters a row, each after a letter of its own, so that marks don't move across."""
    codes = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    rows = [("x" + "x".join(map(chr, codes[i : i + 64])),) for i in range(0, len(codes), 64)]
    got = spark.createDataFrame(rows, "t string").repartition(4).select("t", nfkd(F.col("t")).alias("n"))
    wrong = [r.t for r in got.collect() if r.n != unicodedata.normalize("NFKD", r.t)]
    assert not wrong


def test_marks_in_any_order(spark):
    rnd = random.Random(1)
    marks = [chr(c) for c in range(0x300, 0x340)] + ["֑", "ְ", "゙", "\U0001d165", "ཱ", "ཱི"]
    rows = [("".join(rnd.choice(["a", "é", "ö", "ﬁ", "각", "ǖ", *marks]) for _ in range(rnd.randint(0, 12))),) for _ in range(400)] + [(None,), ("",)]
    got = spark.createDataFrame(rows, "t string").select("t", nfkd(F.col("t")).alias("n")).collect()
    assert all(r.n == (None if r.t is None else unicodedata.normalize("NFKD", r.t)) for r in got)


def test_titles_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("Gällande Ångbåt ﬁ²",)], "t string")
    out = df.select(text.normal_title(F.col("t")).alias("apart"), text.normal_title(F.col("t"), keep_marks_apart=False).alias("bare"))
    assert tuple(out.first()) == ("ga llande a ngba t fi2", "gallande angbat fi2")
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
