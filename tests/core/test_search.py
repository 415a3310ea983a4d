"""Search by the index against the scan."""

import random

from docket.operators import publish


def test_index_finds_what_the_scan_finds(spark, tmp_path):
    rnd = random.Random(5)
    words = ["bike", "Bridge", "park", "ÅNGA", "öl", "a", "motion 12"]
    rows = [(i, f"a-{i}", " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 4))), rnd.choice(["O", "F"]), [(rnd.choice(["n", "m"]), rnd.choice([*words, None])) for _ in range(rnd.randint(0, 3))]) for i in range(300)]
    cases = spark.createDataFrame(rows, "pos long, id string, title string, status string, steps array<struct<instance:string,quote:string>>")
    publish.write_search_index(cases, f"{tmp_path}/index")
    for asked in (("bridge",), ("ånga",), ("bike park", "n"), ("ON 1", None, "O"), ("öl",), ("",), ("nowhere",)):
        got = {r.pos for r in publish.search_indexed(cases, f"{tmp_path}/index", *asked).collect()}
        assert got == {r.pos for r in publish.search(cases, *asked).collect()}
    plan = publish.search_indexed(cases, f"{tmp_path}/index", "bridge")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan or "PartitionFilters: [folder" in plan
    assert "PushedFilters: [In(gram" in plan
    publish.write_search_index(cases.limit(0), f"{tmp_path}/none")
    assert publish.search_indexed(cases.limit(0), f"{tmp_path}/none", "bridge").count() == 0
