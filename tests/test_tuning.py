import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from weftmatch.operators import tuning as U


def f05(p, t):
    if not t:
        return float(not p)
    hit = len(p & t)
    return 1.25 * (hit / len(p)) * (hit / len(t)) / (0.25 * hit / len(p) + hit / len(t)) if hit else 0.0


def test_policies_against_all_options(spark):
    r = random.Random(6)
    scored = {i: [(c, round(r.random(), 2), c % 2) for c in r.sample(range(20), r.randrange(6))] for i in range(60)}
    truth = {i: {c for c, p, _ in x if r.random() < p} for i, x in scored.items()}
    df = spark.createDataFrame([(i, c, p, s) for i, x in scored.items() for c, p, s in x], "s1 long, cand long, p double, is_s3 int")
    tr = spark.createDataFrame([(i, c) for i, x in truth.items() for c in x], "s1 long, cand long")
    got = U.tune_policies(df, tr, spark.range(60).withColumnRenamed("id", "s1"))

    def value(keep):
        return sum(f05({c for c, p, s in x if keep(p, s, max(q for _, q, _ in x))}, truth[i]) for i, x in scored.items()) / 60

    best = max((round(value(lambda p, s, m, t=t: p >= t), 12), t) for t in U.THRESHOLDS)
    assert got["global"] == ({"type": "global", "t": best[1]}, pytest.approx(best[0]))
    near = U._near(best[1])
    two = max((round(value(lambda p, s, m, a=a, b=b: p >= (b if s else a)), 12), a, b) for a, b in product(near, near))
    assert got["source"] == ({"type": "source", "t2": two[1], "t3": two[2]}, pytest.approx(two[0]))
    assert got["abstain"][1] >= got["relative"][1] - 0.05 and got["relative"][1] >= got["global"][1] - 0.05


def test_holdouts(spark):
    e = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (3, "a", 2)], "s1 long, country string, fold int")
    assert [sorted(r["s1"] for r in x.collect()) for x in U.split(e)] == [[2, 3], [1]]
    assert [sorted(r["s1"] for r in x.collect()) for x in U.country_holdout(e, "b")] == [[1, 3], [2]]


def test_unions_of_blocks(spark):
    cands = spark.createDataFrame([(1, 5, 0, -1), (1, 6, 1, 0), (1, 7, 2, 1), (2, 8, 5, 0)], "q long, c long, rank_x int, rank_y int")
    truth = spark.createDataFrame([(1, 5), (1, 6), (2, 8), (3, 9)], "s1 long, cand long")
    unions = [{"x": 2}, {"x": 2, "y": 1}, {"x": 9, "y": 9}]
    found = U.union_recall(cands, truth, unions)
    assert {r["union"]: (r["pairs"], r["recall"]) for r in found.collect()} == {0: (2, 0.5), 1: (3, 0.75), 2: (4, 0.75)}
    assert U.choose_union(found, unions) == unions[1]
    assert U.set_of(truth, spark.createDataFrame([(1, "model")], "s1 long, set string")).where(F.col("set") == "model").count() == 2
