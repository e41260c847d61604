"""Token ids in ORC files.

Documents are dealt out by ranges of their id, sorted, encoded and written: ORC keeps ids as run-length encoded
integers in stripes, with row indexes and a Bloom filter on the document id, so that readers take stripes in parallel
and skip those that cannot hold an id. A running number of tokens needs no single task over the documents: documents
are summed inside their file part, and only the sums of parts are put in one row.

Defined results: a null text is the empty text and has the end id alone; null ids come first; rows with equal ids are
ordered by a hash of their text; columns other than id and text are ignored, so that none can clash; no rows, no ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from .common import column, prepare

#: The id that ends a document.
END_ID = 2
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1_000


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None, end_id: int = END_ID) -> None:
    """Writes part int, row long (order inside the part), doc_id, ids array<int>."""
    prepare(docs.sparkSession)
    path = vocab or bpe.default_path()
    kind = docs.schema[id_col].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, part, row = bpe.load(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [b.encode(t) + [end_id] for t in column(batch, "text").to_pylist()]
            n = batch.num_rows
            starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = pa.array(np.concatenate([np.array(x, np.int32) for x in ids]) if n else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n)), batch.column(0), pa.ListArray.from_arrays(pa.array(starts), values)], ["part", "row", "doc_id", "ids"])
            row += n

    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = base.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    rows = ordered.mapInArrow(encoded, f"part int, row long, doc_id {kind}, ids array<int>")
    rows.write.options(**{"compression": "zstd", "orc.stripe.size": str(STRIPE_BYTES), "orc.row.index.stride": str(INDEX_ROWS), "orc.create.index": "true", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}).orc(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.orc(folder)


def lookup(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """The ids of some documents; stripes and row groups without them are skipped by their index."""
    return read_tokens(spark, folder).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def document_index(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of written files."""
    kind = files.schema["doc_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            starts, values = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4", copy=False)
            crc = [zlib.crc32(values[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(starts).astype(np.int64)), pa.array(crc, pa.int64())], ["part", "row", "doc_id", "n_tokens", "ids_crc32"])

    rows = files.select("part", "row", "doc_id", "ids").mapInArrow(digest, f"part int, row long, doc_id {kind}, n_tokens long, ids_crc32 long")
    inside = rows.withColumn("upto", F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row")))
    parts = files.groupBy("part").agg(F.sum(F.size("ids").cast("long")).alias("total"))  # one row for each file part
    before = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    return inside.join(before, "part").select("doc_id", (F.col("before") + F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")
