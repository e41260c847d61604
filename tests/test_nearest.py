"""Retrieval in blocks against brute force."""

import math
import random

from pyspark.sql import functions as F

from weftmatch.operators import blocking as B
from weftmatch.operators import profile as R
from weftmatch.operators.nearest import ROUND, SLICE, _rounds, nearest


def test_blocks_against_brute_force(spark):
    rng = random.Random(3)
    vectors = {(s, 1000 * s + i): {rng.randrange(60): rng.choice((0.5, 1.0, 2.0)) for _ in range(rng.randrange(1, 9))} for s in (1, 2, 3) for i in range(120)}
    for i in range(40):  # copies: ties go by code
        vectors[(2, 2500 + i)] = vectors[(2, 2000)]
    rows = [("x", code, s, t, w) for (s, code), v in vectors.items() for t, w in v.items()]
    df = spark.createDataFrame(rows, "country string, code long, source int, id long, w double")
    unit = {key: {t: w / math.sqrt(sum(x * x for x in v.values())) for t, w in v.items()} for key, v in vectors.items()}
    want = set()
    for (s, q), a in unit.items():
        if s == 1:
            scores = [(-math.floor(sum(w * b.get(t, 0.0) for t, w in a.items()) * 1e9 + 0.5), c) for (z, c), b in unit.items() if z != 1]
            want |= {(q, c, r) for r, (x, c) in enumerate(sorted(scores)[:7]) if x < 0}
    for cell in (100, 10**6):  # many blocks and one
        got = nearest(df, 7, cell=cell)
        assert {(r["q"], r["c"], r["rank"]) for r in got.collect()} == want
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()  # pairs that share a token are no rows


def test_rounds_copy_a_bounded_share():
    countries = [("en", 9_000, 21_000), ("de", 2_000, 5_000), *((f"c{i}", 3, 5) for i in range(50))]
    rounds, total = _rounds(countries, 100), sum(q + c for _, q, c in countries)
    assert len(rounds) > 10
    met = []
    for part in rounds:
        size = {c: (q, e) for c, q, e in countries}
        assert sum((high - low) * (slices * size[c][1] / n + size[c][0]) for c, n, slices, low, high, _ in part) <= ROUND * total
        met += [(c, b) for c, _, _, low, high, _ in part for b in range(low, high)]
        own = [p + x for c, n, slices, low, high, p in part for x in range((high - low) * slices) if n * slices > 1]
        assert len(own) == len(set(own))  # a large country's tasks are its own
    assert len(met) == len(set(met)) and set(met) == {(c, b) for c, _, e in countries for b in range(max(1, -(-e // 100)))}
    assert SLICE * 100 >= max(q / next(s for c, _, s, *_ in rounds[0] if c == "en") for c, q, _ in countries if c == "en")


def test_a_record_given_twice_counts_once(spark):
    rec = spark.createDataFrame([("x", 1, 1, "a b a"), ("x", 1, 1, "a c"), ("x", 2, 2, "b")], "country string, code long, source int, t string")
    tok = B.field_counts(rec, {"n": F.split("t", " ")})
    assert sorted((r["code"], r["token"], r["tf"]) for r in tok.collect()) == [(1, "a", 3), (1, "b", 1), (1, "c", 1), (2, "b", 1)]


def test_scripts_send_a_row_for_a_script(spark):
    df = spark.createDataFrame([("aab1",), ("жa",), (None,), ("",), ("\n",)], "t string").repartition(1)
    got = R.script_counts(df, "t")
    assert {(r["script"], r["rows_with"], r["n_chars"]) for r in got.collect()} == {("LATIN", 2, 4), ("DIGIT", 1, 1), ("CYRILLIC", 1, 1), ("UNKNOWN", 1, 1)}
    assert "explode" not in got._jdf.queryExecution().optimizedPlan().toString()
