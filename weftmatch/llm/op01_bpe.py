"""BPE encoding and decoding by tree concatenation.

A text is a tree of leaves of LEAF_CHARS characters, joined pairwise: at each join, growing windows of ids are encoded again
until both sides agree (see bpe.ByteBpe.join). Texts of at most part_chars characters are one part, whose tree is built
where it is read. Longer texts are cut into parts that are dealt out and encoded in parallel; then neighbouring parts,
FAN_IN at a time, are joined level by level, each level a shuffle of ids alone, until one is left.

Defined results: a null text is the empty text; an empty text has no ids; rows with a repeated or null id stay rows of
their own; columns other than id and text are ignored, so that none can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import column, lean, prepare

#: Characters of a part, and parts of one document that are joined in one task.
PART_CHARS, FAN_IN = 65_536, 32


def _arrow(ids: list[list[int]]) -> pa.Array:
    return pa.array([np.array(x, "<u4").tobytes() for x in ids], pa.binary())


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None, part_chars: int = PART_CHARS, leaf_chars: int = bpe.LEAF_CHARS, fan_in: int = FAN_IN) -> DataFrame:
    """id, token_ids (binary: little-endian unsigned 32-bit integers), decoded (string)."""
    prepare(docs.sparkSession)
    path = vocab or bpe.default_path()
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    @lean
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe.load(path)
        for batch in batches:
            ids = [b.encode_tree(t, leaf_chars) for t in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _arrow(ids), pa.array([b.decode(x) for x in ids], pa.string())], ["id", "token_ids", "decoded"])

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe.load(path)
        for batch in batches:
            for row in batch.to_pylist():
                parts = b.cuts(row["text"], part_chars)
                n = len(parts)
                yield pa.RecordBatch.from_arrays([pa.array([row["key"]] * n, pa.int64()), pa.array([row["id"]] * n, batch.schema.field("id").type), pa.array(range(n), pa.int32()), pa.array(parts, pa.string())], ["key", "id", "part", "text"])

    @lean
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe.load(path)
        for batch in batches:
            ids = [b.encode_tree(t, leaf_chars) for t in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _arrow(ids)], ["key", "id", "part", "ids"])

    def joined(parts: pa.Table) -> pa.Table:
        b = bpe.load(path)
        rows = sorted(parts.to_pylist(), key=lambda r: r["part"])
        ids = b.concatenate([np.frombuffer(r["ids"], "<u4").tolist() for r in rows])
        return pa.table({"key": parts.column("key")[:1], "id": parts.column("id")[:1], "part": pa.array([rows[0]["part"] // fan_in], pa.int32()), "ids": _arrow([ids])})

    @lean
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe.load(path)
        for batch in batches:
            texts = [b.decode(np.frombuffer(x.as_buffer(), "<u4").tolist()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["id", "token_ids", "decoded"])

    out = f"id {kind}, token_ids binary, decoded string"
    short = base.where(F.char_length("text") <= part_chars).mapInArrow(whole, out)
    long = base.where(F.char_length("text") > part_chars).select(F.monotonically_increasing_id().alias("key"), "id", "text")
    most = long.agg(F.max(F.char_length("text")).alias("n")).first()["n"] or 0  # one number
    part = f"key long, id {kind}, part int"
    tree = long.mapInArrow(cut, f"{part}, text string").repartition("key", "part").mapInArrow(encoded, f"{part}, ids binary")
    parts = -(-most // part_chars)  # of the longest text, at most
    while parts > 1:
        tree = tree.groupBy("key", F.floor(F.col("part") / fan_in).alias("node")).applyInArrow(joined, f"{part}, ids binary")
        parts = -(-parts // fan_in)
    return short.unionByName(tree.select("id", F.col("ids").alias("token_ids")).mapInArrow(decoded, out)).withColumnRenamed("id", id_col)
