import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftmatch.llm import bpe, op01_bpe, op07_orc, op10_counts

ALPHABET = ["a", "b", "the", "'", "'ll", "s", " ", "  ", "\n", "é", "日本", "1", "23", "!", "<|endoftext|>", "　", "ing", "er", "\x1d", "ll", "😀", "_"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def b():
    return bpe.load(bpe.default_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_tree_equals_library(b, library, monkeypatch):
    r = random.Random(5)
    b.joins = 0
    for _ in range(1500):
        letters = r.sample(ALPHABET, r.choice([1, 2, 5, 9, 22]))
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 200)))
        monkeypatch.setattr(bpe, "WINDOW", r.choice([1, 2, 8]))
        leaf = r.choice([1, 2, 3, 7, 50])
        assert "".join(b.cuts(text, leaf)) == text
        got = b.encode_tree(text, leaf)
        assert got == ids_of(library, text) and b.decode(got) == text
    assert b.joins > 10_000


@pytest.mark.parametrize("text", ["a" * 70_000, "the" * 30_000, "日本" * 20_000, " " * 50_000, "x " + "\n" * 9_000 + " y", "!" * 9_000 + "'s", "word " * 3_000 + "'" * 5_000 + "re"])
def test_long_runs(b, library, text):
    assert b.encode_tree(text) == ids_of(library, text)


def test_windows_stay_small(b, library):
    """Every join of a text with breaks is settled by windows of few ids; none encodes a whole side again."""
    text = "Some words, and 12 numbers; don't stop. " * 4_000
    b.joins = b.windows = 0
    assert b.encode_tree(text) == ids_of(library, text)
    assert b.joins == -(-len(text) // bpe.LEAF_CHARS) - 1 and b.windows <= 3 * b.joins


@pytest.mark.parametrize("sizes", [{}, {"part_chars": 64, "leaf_chars": 16, "fan_in": 2}, {"part_chars": 50, "leaf_chars": 7, "fan_in": 3}])
def test_encode_decode(docs, rows, library, sizes):
    got = Counter((r["doc_id"], bytes(r["token_ids"]), r["decoded"]) for r in op01_bpe.encode_decode(docs, **sizes).collect())
    assert got == Counter((i, np.array(ids_of(library, t), "<u4").tobytes(), t or "") for i, t in rows)


def test_orc_files(spark, docs, rows, library, tmp_path):
    op07_orc.write_tokens(docs, f"file://{tmp_path}/t")
    got = op07_orc.document_index(op07_orc.read_tokens(spark, f"file://{tmp_path}/t")).orderBy("start").collect()
    ids = {t: [*ids_of(library, t), 2] for _, t in rows}
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((i, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for i, t in rows)
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    one = op07_orc.lookup(spark, f"file://{tmp_path}/t", [400])
    assert [list(r["ids"]) for r in one.collect()] == [ids["a" * 5000]]
    plan = one._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id, [400])" in plan or "EqualTo(doc_id,400)" in plan


def test_empty_tables(spark, empty, tmp_path):
    assert op01_bpe.encode_decode(empty).count() == 0
    assert op10_counts.apply_edits(op10_counts.build_trees(empty).withColumn("edits", op10_counts.sample_edits())).count() == 0
    op07_orc.write_tokens(empty, f"file://{tmp_path}/e")
    assert op07_orc.document_index(op07_orc.read_tokens(spark, f"file://{tmp_path}/e")).count() == 0


def test_token_tree(b):
    r = random.Random(7)
    make = lambda n: "".join(r.choice(ALPHABET) for _ in range(r.randint(0, n)))
    for _ in range(400):
        text = make(150)
        tree = op10_counts.TokenTree(b, text, r.choice([1, 4, 16, 64]))
        for _ in range(5):
            at, deleted, inserted = r.randint(0, len(text) + 3), r.choice([0, 1, 5, 40]), r.choice(["", make(3), make(40)])
            tree.edit(at, deleted, inserted)
            at = min(at, len(text))
            text = text[:at] + inserted + text[at + deleted :]
            assert tree.text() == text and tree.total == len(b.encode(text))


def test_kept_trees(b):
    """A tree that was stored goes on as the one that was not; only what edits touch is encoded."""
    r = random.Random(17)
    for _ in range(150):
        text = "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 300)))
        size = r.choice([4, 16, 64])
        tree = op10_counts.TokenTree(b, text, size)
        for _ in range(4):
            kept = op10_counts.TokenTree.kept(b, tree.text(), tree.chars, tree.tokens, size)
            assert kept.encoded_chars == 0 and kept.total == tree.total
            edit = (r.randint(0, 300), r.choice([0, 1, 30]), r.choice(["", "x y", "the  end "]))
            tree.edit(*edit)
            kept.edit(*edit)
            assert (kept.text(), kept.total) == (tree.text(), tree.total) and kept.total == len(b.encode(kept.text()))
            tree = kept


def test_counts_after_edits(spark, docs, rows, library, tmp_path):
    trees = op10_counts.store_trees(docs, f"file://{tmp_path}/t")
    got = op10_counts.apply_edits(trees.withColumn("edits", op10_counts.sample_edits())).collect()

    def edited(t):
        n = len(t)
        t = "Note: " + t
        t = t[: n // 2] + t[n // 2 + 5 :]
        at = min(max(n - 2, 0), len(t))
        return t[:at] + " end." + t[at + 3 :]

    assert Counter((r["doc_id"], r["n_tokens"], r["n_tokens_edited"], r["text"], r["tokens"][1]) for r in got) == Counter((i, len(ids_of(library, t)), (m := len(ids_of(library, edited(t or "")))), edited(t or ""), m) for i, t in rows)


def test_edits_touch_little(spark, b, tmp_path):
    """Two rounds of edits on stored trees: what is encoded again is a few leaves for each edit, whatever the text's length."""
    text = "word and more " * 5000
    trees = op10_counts.store_trees(spark.createDataFrame([(1, text), (None, text)], "doc_id long, text string"), f"file://{tmp_path}/t")
    edits = spark.createDataFrame([(1, 2, 30_000, 3, "new"), (1, 1, 10, 0, "x"), (1, 3, 5, None, None)], "doc_id long, seq int, position long, deleted long, inserted string")
    once = op10_counts.apply_edits(op10_counts.attach_edits(trees, edits))
    rows = {r["doc_id"]: r for r in once.collect()}
    said = text[:10] + "x" + text[10:]
    said = said[:30_000] + "new" + said[30_003:]
    assert rows[1]["text"] == said and rows[1]["n_tokens_edited"] == len(b.encode(said)) and rows[1]["chars_reencoded"] < 10 * op10_counts.LEAF_CHARS
    assert (rows[None]["chars_reencoded"], rows[None]["n_tokens"]) == (0, len(b.encode(text)))
    once.select("doc_id", "text", "chars", "tokens").write.parquet(f"file://{tmp_path}/u")
    again = spark.read.parquet(f"file://{tmp_path}/u").withColumn("edits", op10_counts.sample_edits()).where("doc_id = 1")
    r = op10_counts.apply_edits(again).first()
    assert r["n_tokens"] == len(b.encode(said)) and r["n_tokens_edited"] == len(b.encode(r["text"])) and r["chars_reencoded"] < 10 * op10_counts.LEAF_CHARS


def test_digests(spark, library):
    df = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    r = op01_bpe.encode_decode(df).select(F.sha2("token_ids", 256).alias("a")).first()
    assert r["a"] == hashlib.sha256(np.array(ids_of(library, "hello world"), "<u4").tobytes()).hexdigest()
