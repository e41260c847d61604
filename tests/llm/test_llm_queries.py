"""The registered queries against DuckDB where SQL can express them, and the pipeline against its stages."""

import os

import duckdb
import pytest

from weftmatch.llm.oracles import ORACLES
from weftmatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    want = con.sql(ORACLES[name])
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_a_row_for_each(spark, name):
    df = QUERIES[name](spark, SF)
    table, key = ("pages", "page_id") if "page_id" in df.columns else ("documents", "doc_id")
    assert sorted(r[0] for r in df.select(key).collect()) == sorted(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())


def test_pipeline(spark):
    """What comes out against the operators' own decisions, and groups by brute force."""
    import corpus_pipeline
    from test_texts import brute_components

    got = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SF).collect()}
    all_rows = {n: {r["doc_id"]: r for r in QUERIES[n](spark, SF).collect()} for n in ("op1_bpe_tree", "op5_quality_crf", "op6_decontamination")}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = [(i, texts[i]) for i, r in sorted(all_rows["op5_quality_crf"].items()) if r["kept"]]
    first = {c for _, _, c in brute_components(good, corpus_pipeline.NEAR_WIDTH, corpus_pipeline.NEAR_PERCENT)}
    assert set(got) == {i for i in first if not all_rows["op6_decontamination"][i]["contaminated"]}
    assert all(n == all_rows["op1_bpe_tree"][i]["n_tokens"] for i, n in got.items())
