import pytest

from weftmatch.sources import sinks, tables

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def test_tsv(spark, tmp_path):
    p = tmp_path / "s.tsv"
    p.write_text(HEAD + 'S2-1\tJoe\'s "Best" Diner\t12 Main St, NA\tUS\nS2-2\tNA\t\tIndia\nS2-3\t"Quoted\tstart only\tUS\n', encoding="utf-8")
    rows = {r["entity_id"]: r for r in tables.read_tsv(spark, str(p), tables.SOURCE_COLUMNS).collect()}
    assert len(rows) == 3 and rows["S2-1"]["business_name"] == 'Joe\'s "Best" Diner' and rows["S2-2"]["business_address"] == "" and rows["S2-2"]["business_name"] == "NA" and rows["S2-3"]["business_name"] == '"Quoted'
    with pytest.raises(ValueError, match="columns"):
        tables.read_tsv(spark, str(p), ["a"])
    counts, bad = tables.raw_line_check(spark, str(p))
    assert counts.first()["with_quote"] == 2 and bad.count() == 0
    assert tables.cached(spark, str(p), tables.SOURCE_COLUMNS, str(tmp_path / "cache")).count() == 3


def test_submission(spark, tmp_path):
    code = lambda k, n: k * 10**10 + n
    ents = spark.createDataFrame([(code(1, i), i) for i in (1, 2, 3)], "s1 long, pos int")
    cands = spark.createDataFrame([(code(1, 1), code(2, 10), 0.9), (code(1, 1), code(3, 11), 0.5), (code(1, 1), code(2, 10), 0.9), (code(1, 2), code(3, 12), 0.7)], "s1 long, cand long, score double")
    matches = cands.where("score > 0.6")
    stats = sinks.write_submission(ents, cands, matches, str(tmp_path))
    assert stats["matching_results_rows"] == 3
    assert (tmp_path / "matching_results.tsv").read_text() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-10\nS1-2\tS3-12\nS1-3\t\n"
    assert "S1-1\tS2-10,S3-11\n" in (tmp_path / "candidate_pairs.tsv").read_text()
    back = sinks.read_id_list(spark, str(tmp_path / "matching_results.tsv"))
    assert {(r["s1"], r["cand"]) for r in back.collect()} == {(r["s1"], r["cand"]) for r in matches.collect()}
    names = spark.createDataFrame([(f"S1-{i}",) for i in (1, 2, 3)], "entity string")
    assert sinks.validate(spark, str(tmp_path / "matching_results.tsv"), str(tmp_path / "candidate_pairs.tsv"), names) == ([], [])
    more = matches.unionByName(spark.createDataFrame([(code(1, 1), code(3, 99), 0.9)], matches.schema))
    with pytest.raises(ValueError, match="no candidate"):
        sinks.write_submission(ents, cands, more, str(tmp_path / "x"))


def test_list_errors(spark):
    lists = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-1", "S1-9"), ("S1-8", "Q1")], "entity string, ids string")
    ents = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity string")
    known = spark.createDataFrame([("S2-7",)], "id string")
    found = {r["rule"]: r["n"] for r in sinks.list_errors(lists, ents, known).collect()}
    assert found == {"duplicate_entity": 1, "duplicate_id": 1, "self_match": 1, "bad_prefix": 1, "missing_entity": 1, "extra_entity": 1, "unknown_id": 1}


def test_log(spark, tmp_path):
    path = str(tmp_path / "log")
    sinks.log_experiment(spark, path, {"id": "base_1", "f05": 0.5})
    sinks.log_experiment(spark, path, {"id": "x_2", "stage": "other"})
    assert [r["id"] for r in sinks.read_log(spark, path, "base").collect()] == ["base_1"]
    with pytest.raises(ValueError):
        sinks.log_experiment(spark, path, {"odd": 1})
