import random
import time

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from weftmatch.functions import similarity as S

words = st.text("abcd ", max_size=12)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@given(words, words)
def test_lcs(a, b):
    assert S.lcs_length(a, b) == lcs(a, b)


@settings(deadline=None, max_examples=60)
@given(st.text("abcd", min_size=1, max_size=9), st.text("abcd", min_size=1, max_size=9))
def test_against_duckdb(a, b):
    jw, dl = duckdb.sql(f"SELECT jaro_winkler_similarity('{a}', '{b}'), damerau_levenshtein('{a}', '{b}')").fetchall()[0]
    assert abs(S.jaro_winkler(a, b) - jw) < 1e-9
    assert S.damerau_levenshtein(a, b) == dl


@given(words, words)
def test_partial_ratio(a, b):
    """Against all parts without bounds."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    n = len(short)
    want = max((S.ratio(short, long[max(0, k) : k + n]) for k in range(1 - n, len(long))), default=0.0) if short else 100.0 * (not long)
    assert S.partial_ratio(a, b) == want


def test_edges():
    assert S.ratio("", "") == 100 and S.ratio("a", "") == 0
    assert S.token_set_ratio("", "") == 0 and S.token_set_ratio("a b", "b") == 100
    assert S.token_sort_ratio("b a", "a b") == 100
    assert S.partial_ratio("abc", "xxabcxx") == 100


def test_columns(spark):
    df = spark.createDataFrame([("ab", "ab"), (None, "a"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(S.ratio_col("a", "b")).collect()] == [100.0, None, 100.0]


def dl(a, b):
    """Lowrance and Wagner, a place at a time."""
    seen, far = {}, len(a) + len(b)
    d = {(-1, -1): far} | {(i, -1): far for i in range(len(a) + 1)} | {(-1, j): far for j in range(len(b) + 1)} | {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, x in enumerate(a, 1):
        last = 0
        for j, y in enumerate(b, 1):
            k, m = seen.get(y, 0), last
            d[i, j] = min(d[i - 1, j - 1] + (x != y), d[i, j - 1] + 1, d[i - 1, j] + 1, d[k - 1, m - 1] + (i - k - 1) + 1 + (j - m - 1))
            last = j if x == y else last
        seen[x] = i
    return d[len(a), len(b)]


@settings(deadline=None, max_examples=200)
@given(st.text("abcé", max_size=30), st.text("abcé", max_size=30))
def test_damerau_levenshtein(a, b):
    assert S.damerau_levenshtein(a, b) == dl(a, b)


def texts(*lengths):
    r = random.Random(3)
    return ["".join(r.choices("abcdefghijklmnopqrstuvwxyz é", k=n)) for n in lengths]


def test_long_texts(monkeypatch):
    a, b = texts(300, 400)
    want = lcs(a, b), dl(a, b)
    for long in (1, 350, 10_000):
        monkeypatch.setattr(S, "LONG", long)
        assert (S.lcs_length(a, b), S.damerau_levenshtein(a, b)) == want


def test_long_texts_in_time():
    """Parts and distances of names of thousands of characters, as first lines can be, don't take a step for each two characters."""
    a, b = texts(1500, 2000)
    began = time.process_time()
    assert S.ratio(a, b[250:1750]) <= S.partial_ratio(a, b) < 100 and S.damerau_levenshtein(a, b) > 500
    assert time.process_time() - began < 2
