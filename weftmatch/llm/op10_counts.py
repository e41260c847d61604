"""Edit-aware token counts.

A document is kept as leaves of about LEAF_CHARS characters, cut only where a piece of the tokenizer ends in any
context (between a character that isn't white space and one that is), so that counts of leaves add up. Two segment
trees over the leaves hold sums of characters and of tokens. An edit finds its leaves by descending the tree of
characters, encodes only those again, with neighbours while a cut is no longer valid, and updates the sums above them.

Trees are a table, one row for each document: the text, and both trees as arrays (sums[1] is the root, the leaves stand at
the end). `build_trees` makes it, and is the only step that encodes whole texts; `apply_edits` takes it with edits and gives
the table after them, whose untouched leaves keep their counts without being encoded. Both may be stored and read again.

Defined results: a null text is the empty text with 0 tokens; a null list of edits is empty; edits are applied in
their order, each to the text that the one before left; positions beyond the text mean its end, negative ones its
start; a null insertion is empty; rows with repeated or null ids stay rows of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import column, prepare

LEAF_CHARS = 1_024


def cut(text: str, leaf: int = LEAF_CHARS) -> list[str]:
    """Leaves of a text; a run without a cut is one leaf, however long."""
    out, at = [], 0
    while len(text) - at > leaf:
        found = bpe._BREAK.search(text, at + leaf - 1)
        if not found:
            break
        out.append(text[at : found.end()])
        at = found.end()
    return [*out, text[at:]] if at < len(text) else out


class TokenTree:
    """Leaves of one document with sums of characters and tokens above them."""

    def __init__(self, b: bpe.ByteBpe, text: str, leaf: int = LEAF_CHARS):
        self.b, self.leaf, self.encoded_chars, self.encoded_leaves = b, leaf, 0, 0
        self._build(cut(text, leaf))

    @classmethod
    def kept(cls, b: bpe.ByteBpe, text: str, chars: list[int], tokens: list[int], leaf: int = LEAF_CHARS) -> TokenTree:
        """A stored tree; nothing is encoded."""
        tree = cls.__new__(cls)
        tree.b, tree.leaf, tree.encoded_chars, tree.encoded_leaves = b, leaf, 0, 0
        tree.n, tree.chars, tree.tokens, tree.leaves, at = len(chars) // 2, list(chars), list(tokens), [], 0
        for size in chars[tree.n :]:
            tree.leaves.append(text[at : at + size])
            at += size
        while tree.leaves and not tree.leaves[-1]:
            tree.leaves.pop()
        return tree

    def _build(self, leaves: list[str], counts: list[int] | None = None) -> None:
        self.leaves = leaves
        n = 1
        while n < len(leaves):
            n *= 2
        self.n = n
        counts = counts if counts is not None else [self._count(x) for x in leaves]
        self.tokens = [0] * n + counts + [0] * (n - len(counts))
        self.chars = [0] * n + [len(x) for x in leaves] + [0] * (n - len(leaves))
        for k in range(n - 1, 0, -1):
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]

    def _count(self, text: str) -> int:
        self.encoded_chars += len(text)
        self.encoded_leaves += 1
        return len(self.b.encode(text))

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def _leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character, and how many characters come before it."""
        k, before = 1, 0
        while k < self.n:
            k *= 2
            if position >= before + self.chars[k] and self.chars[k + 1]:
                before += self.chars[k]
                k += 1
        return k - self.n, before

    def _put(self, i: int, text: str, count: int) -> None:
        self.leaves[i] = text
        k = i + self.n
        self.chars[k], self.tokens[k] = len(text), count
        while k > 1:
            k //= 2
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]

    def edit(self, position: int, deleted: int, inserted: str) -> None:
        size = self.chars[1]
        position = min(max(position, 0), size)
        deleted = min(max(deleted, 0), size - position)
        if not self.leaves:
            self._build(cut(inserted, self.leaf))
            return
        i, before = self._leaf_at(position)
        j = self._leaf_at(position + deleted - 1)[0] if deleted else i
        old = "".join(self.leaves[i : j + 1])
        new = old[: position - before] + inserted + old[position - before + deleted :]
        while True:  # an edge that is no valid cut any more takes the next leaf with text in
            left = next((k for k in range(i - 1, -1, -1) if self.leaves[k]), -1)
            right = next((k for k in range(j + 1, len(self.leaves)) if self.leaves[k]), -1)
            if left >= 0 and not (new and bpe._BREAK.match(self.leaves[left][-1] + new[0])):
                new, i = self.leaves[left] + new, left
            elif right >= 0 and not (new and bpe._BREAK.match(new[-1] + self.leaves[right][0])):
                new, j = new + self.leaves[right], right
            else:
                break
        parts = cut(new, self.leaf)
        if len(parts) <= j - i + 1:
            for k in range(i, j + 1):
                part = parts[k - i] if k - i < len(parts) else ""
                if part != self.leaves[k]:
                    self._put(k, part, self._count(part) if part else 0)
        else:  # more leaves than before: the array of leaves grows, other leaves keep their counts
            counts = self.tokens[self.n : self.n + len(self.leaves)]
            self._build(self.leaves[:i] + parts + self.leaves[j + 1 :], counts[:i] + [self._count(x) for x in parts] + counts[j + 1 :])


_TREE = "text string, chars array<int>, tokens array<int>"


def _tree_columns(trees: list[TokenTree]) -> list[pa.Array]:
    return [pa.array([t.text() for t in trees], pa.string()), pa.array([t.chars for t in trees], pa.list_(pa.int32())), pa.array([t.tokens for t in trees], pa.list_(pa.int32()))]


def build_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None) -> DataFrame:
    """id, text, chars, tokens: the segment tree of every document."""
    prepare(docs.sparkSession)
    path = vocab or bpe.default_path()
    kind = docs.schema[id_col].dataType.simpleString()

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe.load(path)
        for batch in batches:
            trees = [TokenTree(b, t) for t in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_tree_columns(trees)], ["id", "text", "chars", "tokens"])

    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return base.mapInArrow(built, f"id {kind}, {_TREE}").withColumnRenamed("id", id_col)


def store_trees(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None) -> DataFrame:
    """The table of trees, written to a folder and read again."""
    trees = build_trees(docs, id_col, text_col, vocab)
    trees.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(trees.schema).parquet(folder)


def apply_edits(trees: DataFrame, edits_col: str = "edits", id_col: str = "doc_id", vocab: str | None = None) -> DataFrame:
    """id, text, chars, tokens after the edits; n_tokens (before), n_tokens_edited, chars_reencoded, leaves_reencoded.

    edits_col: array of struct(position long, deleted long, inserted string), beside the columns of a table of trees.
    """
    prepare(trees.sparkSession)
    path = vocab or bpe.default_path()
    kind = trees.schema[id_col].dataType.simpleString()
    none = F.array().cast("array<struct<position:bigint,deleted:bigint,inserted:string>>")
    base = trees.select(F.col(id_col).alias("id"), "text", "chars", "tokens", F.coalesce(F.col(edits_col), none).alias("edits"))
    names = ["n_tokens", "n_tokens_edited", "chars_reencoded", "leaves_reencoded"]

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe.load(path)
        for batch in batches:
            after, rows = [], []
            for text, chars, tokens, edits in zip(*(batch.column(k).to_pylist() for k in range(1, 5)), strict=True):
                tree = TokenTree.kept(b, text, chars, tokens)
                for e in edits:
                    tree.edit(e["position"] or 0, e["deleted"] or 0, e["inserted"] or "")
                after.append(tree)
                rows.append((tokens[1], tree.total, tree.encoded_chars, tree.encoded_leaves))
            counts = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *_tree_columns(after), *(pa.array(c, pa.int64()) for c in counts)], ["id", "text", "chars", "tokens", *names])

    return base.mapInArrow(edited, f"id {kind}, {_TREE}, {', '.join(f'{n} long' for n in names)}").withColumnRenamed("id", id_col)


def attach_edits(trees: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """trees with a column edits, from rows (id, seq, position, deleted, inserted); edits of null ids are left out."""
    lists = edits.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.col("position").cast("long").alias("position"), F.col("deleted").cast("long").alias("deleted"), "inserted"))), lambda e: F.struct(e["position"].alias("position"), e["deleted"].alias("deleted"), e["inserted"].alias("inserted"))).alias("edits"))
    return trees.drop("edits").join(lists, id_col, "left")


def sample_edits(text: str = "text") -> "F.Column":
    """An edit script of three steps for every document: an insertion at the start, a deletion in the middle, a replacement at the end."""
    n = F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    step = lambda p, d, s: F.struct(p.alias("position"), F.lit(d).cast("long").alias("deleted"), F.lit(s).alias("inserted"))
    return F.array(step(F.lit(0).cast("long"), 0, "Note: "), step(F.floor(n / 2).cast("long"), 5, ""), step(n - 2, 3, " end."))
