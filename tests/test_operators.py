import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from weftmatch.operators import blocking as B
from weftmatch.operators import evaluate as E
from weftmatch.operators import features as X
from weftmatch.operators import mining as M
from weftmatch.operators import policy as P
from weftmatch.operators import sampling as K


def pairs(spark, rows):
    return spark.createDataFrame(rows, "s1 long, cand long")


def entities(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "s1 long")


def scalar_f05(p, t):
    if not t:
        return 1.0 if not p else 0.0
    tp = len(p & t)
    if not tp:
        return 0.0
    a, b = tp / len(p), tp / len(t)
    return 1.25 * a * b / (0.25 * a + b)


def test_f05_example(spark):
    t = E.entity_table(pairs(spark, [(1, 47), (1, 193), (1, 812)]), pairs(spark, [(1, 47), (1, 812)]), entities(spark, [1])).first()
    assert t["f05"] == pytest.approx(0.7142857)


def test_f05_random_and_grid(spark):
    r = random.Random(3)
    truth = {i: {r.randrange(9) for _ in range(r.randrange(4))} for i in range(200)}
    scored = [(i, c, r.random()) for i in range(200) for c in r.sample(range(9), r.randrange(5))]
    tr = pairs(spark, [(i, c) for i, x in truth.items() for c in x])
    df = spark.createDataFrame(scored, "s1 long, cand long, score double")
    steps = [0.0, 0.3, 0.7, 1.1]
    want = {t: sum(scalar_f05({c for j, c, s in scored if j == i and s >= t}, truth[i]) for i in range(200)) / 200 for t in steps}
    grid = E.grid_search(*E.prepare(df, tr, entities(spark, range(200))), spark.createDataFrame([(t,) for t in steps], "threshold double"))
    assert {x["threshold"]: x["f05"] for x in grid.collect()} == pytest.approx(want)
    for t in steps:
        table = E.entity_table(df.where(F.col("score") >= t), tr, entities(spark, range(200)))
        assert E.summarize(table).first()["f05"] == pytest.approx(want[t])


def test_summary(spark):
    s = E.summarize(E.entity_table(pairs(spark, [(2, 9)]), pairs(spark, [(1, 8)]), entities(spark, [1, 2, 3]))).first()
    assert (s["f05"], s["singleton_accuracy"], s["false_merge_rate"]) == (pytest.approx(1 / 3), 0.5, 1.0)


def test_false_merges(spark):
    """Two of three predicting entities have a wrong pair, whatever the number of their pairs; none predicts: 0."""
    pred = pairs(spark, [(1, 7), (1, 8), (1, 9), (2, 5), (3, 4)])
    true = pairs(spark, [(1, 7), (2, 5), (4, 6)])
    t = E.entity_table(pred, true, entities(spark, [1, 2, 3, 4]))
    assert E.summarize(t).first()["false_merge_rate"] == pytest.approx(2 / 3)
    scored = pred.withColumn("score", F.lit(0.5))
    grid = E.grid_search(*E.prepare(scored, true, entities(spark, [1, 2, 3, 4])), spark.createDataFrame([(0.1,), (0.9,)], "threshold double"))
    assert {r["threshold"]: r["false_merge_rate"] for r in grid.collect()} == {0.1: pytest.approx(2 / 3), 0.9: 0.0}


def test_duplicates_and_foreign_entities(spark):
    rows = E.entity_table(pairs(spark, [(1, 7), (1, 7), (99, 5)]), pairs(spark, [(1, 7), (1, 8)]), entities(spark, [1])).collect()
    assert [(r["s1"], r["n_pred"]) for r in rows] == [(1, 1)]


def test_substitutions(spark):
    subs = [("rd", "road", 100), ("center", "private", 90), ("center", "limited", 80), ("shri", "limited", 60), ("ltd", "limited", 50), ("limited", "ltd", 30)]
    df = spark.createDataFrame([("x", *s) for s in subs], "country string, m string, s string, n long")
    ok = M.accept_substitutions(df, 25, 0.5, 70)
    assert {(r["m"], r["s"]) for r in ok.collect()} >= {("rd", "road"), ("ltd", "limited")}
    assert not {r["m"] for r in ok.collect()} & {"center", "shri"}
    freq = spark.createDataFrame([("x", "limited", 10), ("x", "ltd", 3), ("x", "road", 5)], "country string, token string, n long")
    assert {r["token"]: r["canon"] for r in M.build_map(ok, freq).collect()} == {"ltd": "limited", "rd": "road"}


def test_suffix_tokens(spark):
    names = ["alpha sarl", "beta sarl", "gamma sas", "delta club sarl", "sarl"] * 100
    df = spark.createDataFrame([("x", n.split()) for n in names], "country string, toks array<string>")
    assert {"sarl", "sas"} <= {r["token"] for r in M.suffix_tokens(df).collect()}


@pytest.fixture(scope="module")
def seven(spark):
    """Seven records of two businesses and others."""
    rows = [
        (1, 1, "apex healthcare private limited", "a102 anjali chs andheri west mumbai 400053"), (2, 1, "moore bitwise inc", "337 oakland avenue michigan city in"),
        (21, 2, "apex healthcare private limited", "a102 anjali chs andheri west mumbai 400053"), (31, 3, "apex helthcare", "andheri west mumbai"),
        (22, 2, "moore bitwise", "337 oakland avenue michigan city in"), (32, 3, "zeta foods llc", "12 river road salem or"), (33, 3, "moore holdings", "900 pine street dallas tx"),
    ]
    return spark.createDataFrame([("X", i, s, n, a, n, a) for i, s, n, a in rows], "country string, code long, source int, name_raw string, addr_raw string, name_norm string, addr_norm string")


def test_features(spark, seven):
    weak = spark.createDataFrame([("X", w) for w in ("private", "limited", "inc", "llc")], "country string, token string")
    attrs = X.attributes(seven, weak)
    one = dict.fromkeys(B.BLOCK_MAX_DF, 1.0)
    cands = seven.where("source = 1").select(F.col("code").alias("q")).crossJoin(seven.where("source <> 1").select(F.col("code").alias("c")))
    for b in B.BLOCK_K:
        cands = cands.withColumn(f"rank_{b}", F.lit(0))
    out = X.build(cands.withColumn("n_blocks", F.lit(4)), attrs, one)
    assert len(X.feature_columns(out)) == 85
    f = {(r["s1"], r["cand"]): r.asDict() for r in out.collect()}
    assert all(v is not None and v == v for r in f.values() for v in r.values())
    a = f[1, 21]
    assert a["name_exact"] == a["pin_exact_match"] == 1 and a["fielded_cos"] > 0.99 and a["is_top"] == 1
    assert f[1, 32]["fielded_cos"] < 0.3 and f[1, 32]["num_conflict"] == 1 and f[1, 32]["core_idf_cov_a"] == 0
    assert f[2, 22]["core_exact"] == f[2, 22]["house_number_match"] == 1
    assert f[2, 33]["core_idf_cov_a"] > 0 and f[2, 33]["num_conflict"] == 1


def test_blocks(spark, seven):
    tok = X.tokens_of(X.attributes(seven)).where("field in ('name', 'addr', 'num')")
    stats = B.field_statistics(tok, B.country_sizes(seven))
    top = B.topk(B.block_weights(tok, stats, B.BLOCK_FIELDS["fielded"], 1.0), 3)
    best = {r["q"]: r["c"] for r in top.where("rank = 0").collect()}
    assert best == {1: 21, 2: 22}
    cands = B.generate_candidates({"fielded": top, "addr": top})
    assert {r["n_blocks"] for r in cands.collect()} == {2}


def test_policies(spark):
    s = P.entity_stats(spark.createDataFrame([(1, 5, 0.9), (1, 6, 0.3), (2, 7, 0.4)], "s1 long, cand long, p double"))
    got = {r["cand"]: r for r in s.collect()}
    assert (got[5]["p_2nd"], got[7]["p_2nd"], got[5]["rank_p"], got[6]["rank_p"]) == (0.3, 0.0, 0, 1)
    keep = lambda rule: {r["cand"] for r in s.where(P.accept(rule, F.col("p"), p_rel=F.col("p_rel"), p_max=F.col("p_max"))).collect()}
    assert keep({"type": "global", "t": 0.4}) == {5, 7}
    assert keep({"type": "relative", "t": 0.1, "alpha": 0.5}) == {5, 7}
    assert keep({"type": "abstain", "t": 0.1, "alpha": 0.1, "tau": 0.5}) == {5, 6}
    with pytest.raises(ValueError):
        P.accept({"type": "other"}, F.col("p"))


def test_samples(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("k"))
    assert K.stratified_sample(df, ["k"], "id", 0.1).count() == 99  # 33 of 334, 333 and 333
    sizes = [r["count"] for r in K.folds(df, ["k"], "id").groupBy("k", "fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    parts = K.disjoint(df, ["k"], "id", {"a": 0.5, "b": 0.5})
    assert parts.select("id").distinct().count() == parts.count()


def test_numbers_over_cells(spark):
    """The places of rows by cells are those of one window for each group, with null groups and keys and ties."""
    rows = [(g, k) for g in ("a", "b", None) for k in (*range(40), 7, 7, None)]
    df = spark.createDataFrame(rows, "g string, k long")
    got = K.numbered(df, ["g"], F.floor(F.col("k") / 8), ["k"], "r", "n")
    assert got.columns == ["g", "k", "r", "n"]
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("k"))).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g")))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert K.numbered(df.limit(0), ["g"], F.lit(0), ["k"], "r").count() == 0
