"""What travels beside candidate pairs: texts are read once, and rows of pairs stay small."""

import os
import random

import pytest
from pyspark.sql import functions as F

from weftmatch.functions import similarity as S
from weftmatch.operators import features as X
from weftmatch.operators import policy as P
from weftmatch.plans import linkage as L
from weftmatch.plans.records import records, truth

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@needs_tables
def test_truth_joins_no_texts(spark):
    df = truth(records(spark, SF))
    assert not any("documents" in f for f in df.inputFiles()) and "name_norm" not in plan(df)


@needs_tables
def test_features_of_pairs_shuffle_no_counts_of_texts(spark, monkeypatch):
    pred = spark.createDataFrame([(20000000001, 30000000002)], "s1 long, cand long").withColumn("score", F.lit(1.0))
    monkeypatch.setattr(L, "_pred", lambda rec: pred)
    for name in ("set_features_name", "set_features_addr", "numeric_features"):
        assert "Aggregate" not in plan(L.Q[name](spark, SF))


def test_packed_sets(spark):
    df = spark.createDataFrame([(["a", "b", "a"], [], ["b", "c"], ["x"]), ([], ["x", "y"], [], ["y", "x"])], "a array<string>, b array<string>, c array<string>, d array<string>")
    got = df.select(X.packed_common(X.packed(F.col("a"), F.col("b")), X.packed(F.col("c"), F.col("d"))).alias("n")).select("n.*").collect()
    assert [tuple(r) for r in got] == [(1, 3, 0, 1), (0, 0, 2, 2)]


@needs_tables
def test_fuzzy_rule_scores_few_addresses(spark, monkeypatch):
    rec = records(spark, SF).select("code", "source")
    some = rec.where("source = 1").select(F.col("code").alias("s1")).orderBy("s1").limit(12).crossJoin(rec.where("source <> 1").select(F.col("code").alias("cand")).orderBy("cand").limit(40))
    pred = spark.createDataFrame([*some.withColumn("score", F.lit(1.0)).collect(), *truth(records(spark, SF)).withColumn("score", F.lit(1.0)).collect()], "s1 long, cand long, score double")
    monkeypatch.setattr(L, "_pred", lambda rec: pred)
    asked = []
    whole = L._addresses
    every = whole(L._named(spark, SF).select("s1", "cand", S.token_set_col("x", "y").alias("name_sim")), records(spark, SF)).withColumn("combined", P.combined(F.col("name_sim"), F.col("addr_sim"), 0.5))
    want = sorted(map(tuple, P.apply_rule(every, {"type": "fuzzy", "t": 90}).select("s1", "cand", *L.r6("name_sim", "addr_sim", "combined")).collect()))
    monkeypatch.setattr(L, "_addresses", lambda pairs, rec: asked.append(pairs.count()) or whole(pairs, rec))
    assert sorted(map(tuple, L.fuzzy_rule(spark, SF).collect())) == want and want
    assert asked[0] < pred.count()


def test_pair_features_carry_few_texts(spark, monkeypatch):
    """Raw texts and token arrays of addresses don't travel beside pairs, and numbers are summed up before texts join them."""
    rec = spark.createDataFrame([("X", i, s, "a b", "1 c, d", "a b", t) for i, s, t in ((1, 1, "1 c d"), (2, 2, "1 c d"), (2, 2, "c d"), (3, 3, ""))], "country string, code long, source int, name_raw string, addr_raw string, name_norm string, addr_norm string")
    attrs = X.attributes(rec)
    assert attrs.count() == 4  # two records of one code stay two
    assert "Join" not in plan(attrs) and "Aggregate" not in plan(attrs)  # whole records aren't shuffled
    kept = {}
    real = X.stored
    monkeypatch.setattr(X, "stored", lambda df, name: kept.setdefault(name, real(df, name)))
    cands = spark.createDataFrame([(1, 3, 0, 0, 0, 0, 4)], "q long, c long, " + ", ".join(f"rank_{b} int" for b in ("fielded", "addr", "name_char", "name_word")) + ", n_blocks int")
    row = X.build(cands, attrs).collect()[0]
    assert not {"addr_raw", "name_raw", "addr_t"} & set(kept["attributes"].columns)
    assert not any(f.dataType.typeName() in ("string", "struct") for f in kept["sums"].schema)
    assert row["b_addr_empty"] == 1 and row["addr_ntok_a"] == 3 and row["addr_common"] == 0 and row["comp_common"] == 2


def test_scores_equal_their_definitions(spark):
    """The Java function gives what similarity.py does, without a Python worker."""
    r, rows = random.Random(7), [(None, "a"), ("a", None), ("", ""), ("", "a")]
    for letters in ("ab ", "abcdefghij0123    ", "abé😀～ \xa0"):
        for most in (3, 12, 80, 600):
            for _ in range(12):
                x, y = ("".join(r.choices(letters, k=r.randint(0, most))) for _ in range(2))
                rows += [(x, y), (x, x[: len(x) // 3] + y[:2] + x[len(x) // 2 :])]
    df = spark.createDataFrame(rows, "x string, y string")
    side = lambda c: F.struct(F.col(c).alias("name_norm"), F.col(c).alias("name_core"), F.col(c).alias("addr_norm"))
    got = df.select("x", "y", side("x").alias("a"), side("y").alias("b")).withColumn("s", X.scores(spark, "a", "b"))
    assert "Python" not in plan(got)
    by = {"ratio": S.ratio, "jw": S.jaro_winkler, "dl": S.dl_similarity, "tsort": S.token_sort_ratio, "tset": S.token_set_ratio, "partial": S.partial_ratio}
    by["common"] = lambda a, b: float(len(set(a.replace("\xa0", "_").split()) & set(b.replace("\xa0", "_").split())))
    for row in got.collect():
        none = row["x"] is None or row["y"] is None
        assert row["s"] == [None if none else by[n.split("_")[1]](row["x"], row["y"]) for n in X.SCORES], row[:2]


def test_pairs_meet_sides_in_rounds(spark):
    """What travels beside pairs is bounded by the records: each candidate's pairs are in one round, none is lost or doubled."""
    pairs = spark.createDataFrame([(q, c) for q in range(5) for c in range(100, 120)], "q long, c long")
    sides = spark.createDataFrame([(i, (f"t{i}",)) for i in [*range(4), *range(100, 120)]], "code long, side struct<text:string>")
    sizes = []
    for how, n in (("inner", 80), ("left", 100)):
        got = X._rounds(pairs, X.stored(sides, "sides"), 4, how, "round", lambda d: sizes.append(d.count()) or d.select("q", "c", F.col("a.text").alias("x"), F.col("b.text").alias("y")))
        assert sorted(map(tuple, got.collect())) == [(q, c, f"t{q}" if q < 4 else None, f"t{c}") for q in range(n // 20) for c in range(100, 120)]
    assert len(sizes) == 8 and max(sizes) < 80
