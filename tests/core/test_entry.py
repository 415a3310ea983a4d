"""The driver's contract: every query runs, and equals its SQL where it has one."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from docket.plans.driver import QUERIES
from docket.plans.oracle import ORACLE

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    if name in ORACLE:
        result = duck.execute(ORACLE[name])
        at = [[d[0] for d in result.description].index(c) for c in columns]
        assert got == sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=str)
    assert got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_llm_is_a_leaf():
    """Nothing but the guarded entry imports the training-data operators."""
    root = Path(entry.__file__).parent
    for f in (root / "docket").rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert not re.search(r"import.*\bllm\b|from.*\bllm\b", f.read_text()), f
