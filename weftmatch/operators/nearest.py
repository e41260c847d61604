"""The k best candidates of every query by the product of sparse vectors, exact.

The candidates of a country are dealt into blocks of about CELL entries, its queries into slices of about SLICE. A task is a
block and a slice: the candidates become an inverted index in memory, then the queries stream past it, and only their k best
leave. Every block meets every slice, in rounds: a round copies at most ROUND times the entries of all vectors, and its copies
are gone before the next one. So disk grows with the vectors, not with their square, and never holds the pairs that share a token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..sources.store import drop, stored

#: Entries of a block of candidates, products at once, and places whose best is looked at first.
CELL, CHUNK, LANE = 3_000_000, 300_000, 64
#: Blocks' entries in a slice of queries, and the vectors' entries that a round copies.
SLICE, ROUND = 2, 1.5


class Index:
    """Lists of the candidates that have a token; candidates are numbered in the order of their codes."""

    def __init__(self, codes: pa.Array, ids: list[np.ndarray], ws: list[np.ndarray], lens: np.ndarray):
        """ids, ws: emptied, so that a part is held once."""
        order = pc.sort_indices(codes).to_numpy()
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.codes, self.width = codes.take(pa.array(order)), -(-max(1, len(order)) // LANE) * LANE
        each = np.concatenate(ids)
        ids.clear()
        by = np.argsort(each, kind="stable").astype(np.int32)
        each = each[by]
        self.starts = np.flatnonzero(np.diff(each, prepend=each[:1] - 1))
        self.tokens, self.lens = each[self.starts], np.diff(self.starts, append=len(each))
        del each
        self.docs = np.repeat(place, lens)[by]
        weights = np.concatenate(ws)
        ws.clear()
        self.ws = weights[by]

    def best(self, ids: np.ndarray, ws: np.ndarray, lens: np.ndarray, k: int, min_score: float) -> tuple[np.ndarray, ...]:
        """Of queries one after another: number of the query, of the candidate, score, billionths of the score."""
        none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0))
        if not len(self.tokens) or not len(ids):
            return none
        at = np.minimum(np.searchsorted(self.tokens, ids), len(self.tokens) - 1)
        known = self.tokens[at] == ids
        query, at, ws = np.repeat(np.arange(len(lens)), lens)[known], at[known], ws[known]
        n = self.lens[at]
        first = np.searchsorted(query, np.arange(len(lens) + 1))  # of a query among the known tokens
        ends = np.concatenate(([0], np.cumsum(n)))
        parts, q = [], 0
        while q < len(lens):
            stop = max(q + 1, int(np.searchsorted(ends[first], ends[first[q]] + CHUNK, "right")) - 1)
            a, b = first[q], first[stop]
            if b > a:
                m, base = n[a:b], ends[a]
                where = np.arange(ends[b] - base) + np.repeat(self.starts[at[a:b]] - (ends[a:b] - base), m)
                docs, products = self.docs[where], np.repeat(ws[a:b], m) * self.ws[where]
                for one in range(q, stop):
                    x, y = ends[first[one]] - base, ends[first[one + 1]] - base
                    if y > x:
                        c, score, unit = self._top(np.bincount(docs[x:y], products[x:y], self.width), k, min_score)
                        parts.append((np.full(len(c), one), c, score, unit))
            q = stop
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else none

    def _top(self, sums: np.ndarray, k: int, min_score: float) -> tuple[np.ndarray, ...]:
        """No score below the k-th best maximum of a lane is among the k best."""
        lanes = sums.reshape(-1, LANE).max(axis=1)
        least = np.partition(lanes, -k)[-k] - 1e-8 if len(lanes) > k else 0.0
        c = np.flatnonzero((sums >= least) & (sums > min_score))
        score = sums[c]
        unit = np.floor(score * 1e9 + 0.5)
        if len(c) > k:
            keep = np.lexsort((c, -unit))[:k]
            c, score, unit = c[keep], score[keep], unit[keep]
        return c, score, unit


def _differ(c: pa.Array) -> np.ndarray:
    a, b = c[1:], c[:-1]
    return pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each vector with its length, norm; its entries stand together. Weights stay as they are: few different values take less disk."""
    keys, rest = ["country", "code", "is_query"], None

    def pack(t: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        w = t.column("w").to_numpy(zero_copy_only=False)
        at = pa.array(np.append(starts, t.num_rows), pa.int32())
        return pa.RecordBatch.from_arrays([*(t.column(k).take(pa.array(starts)) for k in keys), pa.ListArray.from_arrays(at, t.column("id")), pa.ListArray.from_arrays(at, pa.array(w)), pa.array(np.sqrt(np.add.reduceat(w * w, starts)))], [*keys, "ids", "ws", "norm"])

    for batch in batches:
        t = batch if rest is None else pa.RecordBatch.from_arrays([pa.concat_arrays([rest.column(c), batch.column(c)]) for c in batch.schema.names], batch.schema.names)
        if not t.num_rows:
            continue
        starts = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([_differ(t.column(k)) for k in keys]))))
        if len(starts) > 1:
            yield pack(t.slice(0, int(starts[-1])), starts[:-1])
        rest = t.slice(int(starts[-1]))  # may go on in the next batch
    if rest is not None:
        yield pack(rest, np.zeros(1, np.int64))


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, lens = batch.column("ids"), pc.list_value_length(batch.column("ids")).to_numpy(zero_copy_only=False)
    ws = batch.column("ws").flatten().to_numpy(zero_copy_only=False) / np.repeat(batch.column("norm").to_numpy(zero_copy_only=False), lens)
    return ids.flatten().to_numpy(zero_copy_only=False), ws, lens


def _met(k: int, min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a block stand together, candidates first."""
        cell, waiting, index = None, [], None
        for batch in batches:
            keys = list(zip(batch.column("country").to_pylist(), batch.column("block").to_pylist(), batch.column("is_query").to_pylist(), strict=True))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if keys[a][:2] != cell:
                    codes = ids = ws = lens = None
                    cell, waiting, index = keys[a][:2], [], None
                if not keys[a][2]:
                    ids, ws, lens = _entries(part)
                    waiting.append((part.column("code"), ids.copy(), ws.copy(), lens))
                    continue
                if index is None:
                    if not waiting:
                        continue
                    codes, ids, ws, lens = map(list, zip(*waiting, strict=True))
                    waiting = []
                    index = Index(pa.concat_arrays(codes), ids, ws, np.concatenate(lens))
                    pa.default_memory_pool().release_unused()
                q, c, score, unit = index.best(*_entries(part), k, min_score)
                if len(q):
                    yield pa.RecordBatch.from_arrays([part.column("code").take(pa.array(q)), index.codes.take(pa.array(c)), pa.array(score), pa.array(unit)], ["q", "c", "score", "unit"])

    return run


def _rounds(countries: list[tuple], cell: int) -> list[list[tuple]]:
    """Rounds of rows (country, n, slices, low, high, part): the blocks from low on and below high, of n, of a country; part: its first task, small countries share one. countries: (country, entries of queries, of candidates)."""
    most = max(ROUND * sum(q + c for _, q, c in countries), 8 * cell)
    out, now, used, tasks, shared = [], [], 0.0, 0, None
    for country, q, c in sorted((x for x in countries if x[1] and x[2]), key=lambda x: -x[1] * x[2]):
        n, slices = max(1, -(-c // cell)), max(1, -(-q // (SLICE * cell)))
        each, low = slices * c / n + q, 0
        while low < n:
            high = min(n, low + max(0 if now else 1, int((most - used) // max(1.0, each))))
            if high == low:
                out.append(now)
                now, used, tasks, shared = [], 0.0, 0, None
                continue
            size, count = (high - low) * each, (high - low) * slices
            if n == slices == 1 and shared is not None and shared + size <= cell:
                shared += size
                now.append((country, n, slices, low, high, tasks - 1))
            else:
                shared = size if n == slices == 1 else None
                now.append((country, n, slices, low, high, tasks))
                tasks += count
            used, low = used + size, high
    return [*out, now] if now else out


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("unit").desc(), "c")) - 1
    return found.withColumn("rank", rank).where(F.col("rank") < k)


def nearest(rows: DataFrame, k: int, min_score: float = 0.0, query_source: int = 1, cell: int = CELL) -> DataFrame:
    """q, c, score, rank: rows (country, code, source, id, w) are entries of vectors, which are made unit; an id belongs to one country. Ties within a billionth by code."""
    spark = rows.sparkSession
    flat = rows.where("country is not null").select("country", "code", (F.col("source") == query_source).alias("is_query"), "id", "w")
    flat = flat.repartition("country", "code").sortWithinPartitions("country", "code", "is_query")
    kept = [flat.schema[c] for c in ("country", "code", "is_query")]
    v = flat.mapInArrow(_packed, StructType([*kept, StructField("ids", ArrayType(rows.schema["id"].dataType)), StructField("ws", ArrayType(DoubleType())), StructField("norm", DoubleType())]))
    written = vectors = stored(v, "vectors")
    if not written.groupBy("code").count().where("count > 1").isEmpty():  # a code of several countries: its products are summed over them
        unit = F.transform("ws", lambda w: w / F.col("norm"))
        vectors = written.groupBy("code", "is_query").agg(F.lit("").alias("country"), F.flatten(F.collect_list("ids")).alias("ids"), F.flatten(F.collect_list(unit)).alias("ws"), F.lit(1.0).alias("norm"))
    n = lambda asked: F.coalesce(F.sum(F.when(F.col("is_query") == asked, F.size("ids"))), F.lit(0))
    countries = [tuple(r) for r in vectors.groupBy("country").agg(n(True), n(False)).collect()]  # a row for each country
    kind, best = rows.schema["code"].dataType.simpleString(), None
    hashed, schema = F.xxhash64("code"), f"q {kind}, c {kind}, score double, unit double"
    for part in _rounds(countries, cell):
        plan = spark.createDataFrame(part, "country string, n long, slices long, low long, high long, part long")
        of = vectors.join(F.broadcast(plan), "country")
        block, piece = F.pmod(hashed, F.col("n")), F.pmod(F.xxhash64("code", F.lit(1)), F.col("slices"))
        of = of.where(F.col("is_query") | ((block >= F.col("low")) & (block < F.col("high"))))
        meets = F.when(F.col("is_query"), F.transform(F.sequence("low", F.col("high") - 1), lambda b: F.struct(b.alias("block"), piece.alias("piece"))))
        meets = meets.otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1), lambda x: F.struct(block.alias("block"), x.alias("piece"))))
        cells = of.withColumn("at", F.explode(meets)).withColumn("block", F.col("at.block"))
        task = F.col("part") + (F.col("block") - F.col("low")) * F.col("slices") + F.col("at.piece")
        tasks = 1 + max(p + (high - low) * slices - 1 for _, _, slices, low, high, p in part)
        cells = cells.select("country", "block", "is_query", "code", "ids", "ws", "norm", task.cast("int").alias("task")).repartitionById(tasks, "task")
        found = stored(cells.drop("task").sortWithinPartitions("country", "block", "is_query").mapInArrow(_met(k, min_score), schema), "nearest")
        if best is not None:
            old, new = best, found
            found = stored(_ranked(old.unionByName(new), k).drop("rank"), "nearest")
            drop(old)
            drop(new)
        best = found
    drop(written)
    return _ranked(spark.createDataFrame([], schema) if best is None else best, k).drop("unit")
