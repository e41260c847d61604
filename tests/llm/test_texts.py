import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from weftmatch.llm import op03_jaccard, op05_quality, op06_decontam
from weftmatch.operators.components import connected

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_components(rows, width=4, percent=85):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(UP))
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return Counter((d, len(sets[i]), min(least[find(i)], default=None) if sets[i] else d) for i, (d, _) in enumerate(rows))


def components(df):
    return Counter(tuple(r) for r in op03_jaccard.jaccard_components(df).select("doc_id", "n_shingles", "component_id").collect())


def test_jaccard(docs, rows):
    assert components(docs) == brute_components(rows)


@pytest.mark.parametrize("settings", [{}, {"GROUP": 5, "TILE": 4, "MEETINGS": 1, "FREQUENT": 256}, {"MU": 1.0, "MEETINGS": 2, "BROADCAST_ROWS": 0}])
def test_jaccard_of_edited_copies(spark, monkeypatch, settings):
    """A large group of near copies around the threshold; small limits make every way of meeting happen."""
    for k, v in settings.items():
        monkeypatch.setattr(op03_jaccard, k, v)
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [[r.choice(vocabulary) for _ in range(80)] for _ in range(4)]
    rows = []
    for i in range(160):
        w = list(bases[i % 4]) if i < 120 else [r.choice(vocabulary) for _ in range(60)] + bases[0][:20]
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((i, " ".join(w)))
    assert components(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)


def test_keep_one(docs, rows):
    kept = [r["doc_id"] for r in op03_jaccard.keep_one(docs).collect()]
    groups = {c for _, n, c in brute_components(rows) if n}
    assert set(kept) >= groups and not {100, 101, 304, 305} & set(kept) and kept.count(405) == 0
    assert op03_jaccard.keep_one(docs).columns == docs.columns


def test_stages_with_clashing_names(spark):
    """Columns named as the stages name theirs; rows that repeat id and text are one, whose other columns come first."""
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(1, words, 5, "b", 1, "k"), (1, words, 5, "a", 1, "k"), (2, words, 6, "c", 2, "k"), (3, None, 7, "d", 3, "k"), (3, None, 7, "d", 3, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_id long, kept_mark string, KEPT_ID_ long, dirty_key string")
    got = op03_jaccard.keep_one(df)
    assert got.columns == df.columns and sorted((tuple(r) for r in got.collect()), key=str) == [(1, words, 5, "a", 1, "k"), (3, None, 7, "d", 3, "k")]
    items = spark.createDataFrame([(1, words)], "item_id long, text string")
    clean = op06_decontam.clean_documents(df, items)
    assert clean.columns == df.columns and {r["doc_id"] for r in clean.collect()} == {3}


def test_empty_join(empty):
    assert op03_jaccard.jaccard_components(empty).count() == 0


def test_connected(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(40)]
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    loops = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: c for x, c in root.items() if x in loops}


def brute_quality(t):
    w = WORD.findall(t)
    tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    cover = {k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(cover)]


def test_quality_counts(docs, rows):
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], r["kept"]) for r in op05_quality.judge(docs, None).collect())

    def want(i, t):
        c = brute_quality(t or "")
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        return (i, *c, failed, not failed)

    assert got == Counter(want(i, t) for i, t in rows)


def test_quality_counts_random():
    r = random.Random(1)
    for _ in range(150):
        texts = ["".join(r.choice(["a", "b", "é", "\n", " ", "\t", "a b c ", "日", "|", "\n\n", "\x0b", "😀"]) for _ in range(r.choice([0, 1, 5, 50, 200]))) for _ in range(r.choice([1, 2, 9]))]
        assert op05_quality.measure(pa.array(texts)).counts.tolist() == [brute_quality(t) for t in texts]


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(50):
        chain = op05_quality.Chain(rng.normal(size=op05_quality.N_FEATURES), rng.normal(size=(2, 2)))
        x = rng.normal(size=(6, op05_quality.N_FEATURES))
        value = lambda path: sum((x[i] @ chain.emit) * y for i, y in enumerate(path)) + sum(chain.move[a, b] for a, b in zip(path, path[1:], strict=False))  # noqa: E731, B023
        assert value(chain.decode(x).tolist()) == pytest.approx(max(map(value, itertools.product((0, 1), repeat=6))))


def test_quality_on_held_out_labels(spark):
    """Trained on half of the labels: accuracy on the other half."""
    import os

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    chain = op05_quality.train(d, labels.where("doc_id % 2 = 0"))
    rows = op05_quality.judge(d, chain).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    assert sum(r["kept"] == bool(r["quality"]) for r in rows) / len(rows) > 0.95
    assert any(0 < r["content_share"] < 1 for r in rows)  # lines of one document with both labels


def test_line_labels():
    """Lines of a good document are boilerplate where they repeat, or recur in unrelated documents; copies are no recurrence."""
    import numpy as np

    def beside(lines):
        seen = set()
        return np.array([[h, h in seen or seen.add(h) or 0] for h in lines], np.int64).reshape(-1, 2)

    docs = [([1, 7, 2], 1), ([3, 7, 4], 1), ([5, 7, 6, 5], 1), ([7], 1), ([9, 8], 0), ([], 1)]
    docs += [([900 + i if k == i else 20 + k for k in range(12)], 1) for i in range(12)]  # near copies: one line of each is its own
    got = op05_quality.line_labels([(beside(x), y) for x, y in docs])
    assert [g.tolist() for g in got] == [[1, 0, 1], [1, 0, 1], [1, 0, 1, 0], [0], [0, 0], [], *[[1] * 12] * 12]


def test_chain_marks_lines_of_one_text():
    """Trained on line labels: a text with both kinds of lines gets both labels, and its share of content words."""
    r = random.Random(3)
    prose = lambda: " ".join(r.choice(["river", "stone", "walked", "along", "quiet", "house"]) for _ in range(r.randint(14, 20))) + "."
    junk = lambda: "### " + " ".join(r.choice(["BUY", "NOW", "$$$", "%%%"]) for _ in range(r.randint(3, 5)))
    texts = ["\n".join((prose if kind else junk)() for _ in range(r.randint(2, 9))) for kind in (0, 1) * 40] + ["\n".join([prose(), junk(), junk(), prose()]) for _ in range(10)]
    sequences = []
    for k, t in enumerate(texts):
        m = op05_quality.measure(pa.array([t]))
        gold = [int("###" not in line) for line in t.split("\n")]
        sequences.append((m.features, __import__("numpy").array(gold), int(k % 2 or k >= 80)))
    chain = op05_quality.fit(sequences)
    tail = "\n".join([prose(), prose(), prose(), junk(), junk(), junk()])
    got = op05_quality._verdicts(pa.array([tail]), chain, 0.5)
    words = [len(line.split()) for line in tail.split("\n")]
    assert (got[8].to_pylist(), got[9].to_pylist()) == ([6], [3])
    assert got[7].to_pylist() == [pytest.approx(sum(words[:3]) / sum(words))]


def test_text_of_another_type(spark):
    """A text column that isn't a string is cast, as everywhere; no column of the documents is lost or added."""
    df = spark.createDataFrame([(1, bytearray(b"a b c"), "x"), (2, None, "y")], "doc_id long, text binary, said string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    kept = op05_quality.filter_documents(df.union(spark.createDataFrame([(3, bytearray(" ".join(f"w{i}" for i in range(60)).encode()), "z")], df.schema)), none)
    assert kept.columns == df.columns and [(r["doc_id"], r["said"]) for r in kept.collect()] == [(3, "z")]


def test_quality_edges(docs, empty, spark):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    assert op05_quality.train(docs, none) is None
    assert op05_quality.judge(empty, None).count() == 0
    assert op05_quality.filter_documents(docs, none).columns == docs.columns


def brute_hits(t, items, width=10):
    w = TERM.findall((t or "").translate(UP))
    hit, found = set(), set()
    for item, text in items:
        v = TERM.findall((text or "").translate(UP))
        n = min(width, len(v))
        if not n or item is None:
            continue
        windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_decontamination(spark, docs, rows):
    items = [(1, rows[0][1][50:200]), (10, rows[1][1]), (2, "ONE-two"), (3, None), (4, ""), (5, "never seen words here at all"), (None, rows[2][1]), (6, "42"), (7, rows[0][1][50:200])]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in op06_decontam.contamination(docs, table).collect())
    assert got == Counter((i, *brute_hits(t, items)) for i, t in rows)
    clean = op06_decontam.clean_documents(docs, table)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(i for i, t in rows if not brute_hits(t, items)[4])


@pytest.mark.parametrize("rows_to_broadcast", [1_000_000, 0])
def test_windows_with_one_other_word(spark, monkeypatch, rows_to_broadcast):
    """The two rarest words of a window agree and a common one does not; words twice in a window; rows repeated, ids null."""
    monkeypatch.setattr(op06_decontam, "BROADCAST_ROWS", rows_to_broadcast)
    item = "the odd zebra and the the quagga of the and river the"
    texts = [item, item.replace("river", "stone"), item.replace("of", "and"), "x " + item.replace("odd", "the") + " " + item, "zebra quagga the the", "the and the river of " * 4]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, item)] * 3 + [(None, item)] * 4
    items = [(1, item), (2, "quagga the"), (3, "river")]
    df, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in op06_decontam.contamination(df, table).collect())
    assert got == Counter((i, *brute_hits(t, items)) for i, t in rows)


def test_decontamination_edges(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["contaminated"] for r in op06_decontam.contamination(docs, none).collect()} == {False}
    assert op06_decontam.contamination(empty, none).count() == 0


def test_proximity(spark):
    df = spark.createDataFrame([(1, "red x x x blue"), (2, "red x x x x x x blue"), (3, "blue only")], "doc_id long, text string")
    keyed = op06_decontam._keyed(df, "doc_id", "text")
    index = op06_decontam.build_index(keyed, spark.createDataFrame([("red",), ("blue",)], "term string"))
    found = op06_decontam.proximity_matches(index, spark.createDataFrame([(9, ["red", "blue"])], "qid long, terms array<string>"), 4)
    assert [r["key"].split(":")[0] for r in found.collect()] == ["1"]
