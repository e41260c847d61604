"""Every registered query with SQL against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from weftmatch.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET enable_progress_bar = false")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)


@pytest.mark.parametrize("name", ["prenormalize_names", "noise_patterns_all", "unicode_scripts", "indel_ratio", "fuzzy_rule", "isotonic"])
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0
