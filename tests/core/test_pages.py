"""Landed pages as a data source: what is opened, what comes back, streams that go on."""

import os
import time

import pytest
from pyspark.sql import functions as F

from docket.sources import pages


def made(spark, rows):
    return spark.createDataFrame(rows, pages.SCHEMA)


ROWS = [(b, f"2024-0{m}-1{k}", f"p{k}.html", f"<p>{b} {m} {k} å</p>") for b in ("kf", "ks", "n/1") for m in (1, 2, 3) for k in range(3)]


def test_round_trip_and_filters(spark, tmp_path):
    at = f"{tmp_path}/pages"
    assert pages.landed(spark, at).count() == 0
    pages.land(made(spark, ROWS), at)
    pages.land(made(spark, [*ROWS[1:3], ("kf", "2024-01-10", "p0", None)]), at)  # again: a page is replaced, by its name with or without .html
    want = {r if r[:3] != ("kf", "2024-01-10", "p0.html") else (*r[:3], "") for r in ROWS}
    assert {tuple(r) for r in pages.landed(spark, at).collect()} == want
    some = pages.landed(spark, at).where("committee_slug = 'ks' and date between '2024-01-11' and '2024-02-10' and html like '%ks%'")
    assert {tuple(r) for r in some.collect()} == {r for r in want if r[0] == "ks" and "2024-01-11" <= r[1] <= "2024-02-10"}
    assert pages.landed(spark, at).where(F.col("committee_slug").isin("n/1", "x") & F.col("date").startswith("2024-03")).count() == 3
    assert pages.landed(spark, at).where("committee_slug = 'x'").count() == 0
    assert pages.landed(spark, at).where("committee_slug is null or date > file").count() == 0
    with pytest.raises(Exception, match="needs a body"):
        pages.land(made(spark, [("kf", "soon", "p", "")]), at)


def test_others_are_not_opened(spark, tmp_path):
    at = f"{tmp_path}/pages"
    pages.land(made(spark, ROWS), at)
    os.mkdir(f"{at}/ks/2024-01-10/p9.html")  # no page
    os.mkdir(f"{at}/ks/later")  # no meeting
    reader = pages._Reader(at)
    rest = list(reader.pushFilters([pages.EqualTo(("committee_slug",), "kf"), pages.GreaterThan(("date",), "2024-02-10"), pages.EqualTo(("html",), "x"), pages.IsNotNull(("date",))]))
    assert [f.attribute for f in rest] == [("html",)]
    folders = [p for part in reader.partitions() for p in part.paths]
    assert sorted(f.split("/")[-2:] for f in folders) == [["kf", d] for d in ("2024-02-11", "2024-02-12", "2024-03-10", "2024-03-11", "2024-03-12")]
    assert pages.landed(spark, at).where("committee_slug = 'kf' and date > '2024-02-10'").count() == 5


def test_stream_goes_on_at_its_offset(spark, tmp_path):
    at, out, check = (f"{tmp_path}/{x}" for x in ("pages", "out", "check"))

    def drained():
        time.sleep(0.3)
        q = pages.arriving(spark, at, settle=0.1).writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema(pages.SCHEMA).parquet(out).collect())

    pages.land(made(spark, ROWS[:9]), at)
    assert drained() == sorted(ROWS[:9])
    assert drained() == sorted(ROWS[:9])  # restarted with nothing new
    pages.land(made(spark, ROWS[9:]), at)
    assert drained() == sorted(ROWS)  # each page once
