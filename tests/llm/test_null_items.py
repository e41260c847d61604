import duckdb

import corpus_pipeline
from weftmatch.llm.oracles import ORACLES
from weftmatch.llm.queries import QUERIES


def test_items_without_id(spark, tmp_path):
    """The query against its SQL, and the pipeline's stage, with benchmark items of a null id."""
    leak, other, named = (" ".join(f"{w}{k}" for k in range(14)) for w in ("leak", "other", "named"))
    docs = [(1, f"before {leak} after"), (2, f"{named} then {other} then {leak}"), (3, f"only {named}"), (4, "nothing of it"), (5, None)]
    items = [(None, leak), (None, other), (7, named), (8, named), (None, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.sql(ORACLES["op6_decontamination"])
    rows = QUERIES["op6_decontamination"](spark, str(tmp_path)).select(*want.columns).collect()
    assert sorted(map(tuple, rows)) == sorted(want.fetchall())
    assert {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in rows} == {1: (14, 1), 2: (42, 3), 3: (14, 2), 4: (0, 0), 5: (0, 0)}
    clean = corpus_pipeline.decontamination(spark, spark.createDataFrame(docs, "doc_id long, text string"), str(tmp_path))
    assert sorted(r["doc_id"] for r in clean.collect()) == [4, 5]
