"""Exact Jaccard join of documents on word shingles, by T-occurrence search.

A document links with another when their shingle sets have a Jaccard similarity of `percent` or more. Then at least
T = percent of its n shingles are in the other one too, so at least one of any n - T + 1 is. Those are taken from the
rarest shingles (the most frequent ones come last in a common order), which keeps lists short.

1. Equal sets are one class. Frequencies of 32-bit shingle fingerprints are counted over all documents; only the
   FREQUENT most frequent ones, a bounded table, are sent to all tasks and put last in the order of shingles.
2. Lists of classes by rare shingle; lists with one class go. Every pair that links shares a list that stays.
3. Classes meet in blocks: those of the MEETINGS most frequent lists they are in. Large blocks are split by a hash of the
   class, to about GROUP classes and POSTINGS shingles. A block is joined exactly by T-occurrence search in its inverted
   index (DivideSkip: of the lists of a set's shingles the L longest are set apart, the short ones are merged by a heap; what
   occurs T - L times is probed in the long lists by binary search). Sets that are connected already need no link between
   them.
4. Components of these links. Pairs that share a list, but no block, and are in different components are left; all of
   them are compared in full, whatever their number, so that no link between components is lost. Long lists are cut into
   tiles of TILE classes, and pairs of tiles are looked at in parallel.
5. Components of all links, and the smallest document id of each.

Shingles are 64-bit hashes of their words; sets count as equal by a 128-bit sum of them.

Defined results: a null or empty text, or one without words, has n_shingles 0 and links with nothing, component_id is its
own id; a text with fewer words than a shingle has one, all its words; rows with equal sets are in one component, whatever
their ids; a row with a null id has the component's smallest id, null if there is none; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected
from .common import LOWER, column, hash_spans, hash_windows, lean, mix, prepare, slices, stored, text_bytes, unlike, words_of

WIDTH, PERCENT = 4, 85
#: Fingerprints whose frequency is known to all tasks; they only order shingles.
FREQUENT = 2**24
#: Classes, and shingles of theirs, that meet in one block.
GROUP, POSTINGS, MEETINGS = 8_192, 3_000_000, 3
#: Classes of a list of which all pairs are looked at in one task.
TILE = 512
#: Rows (of about 100 bytes: numbers and at most MEETINGS blocks) up to which a table of classes is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 300_000
#: Weight of a probe against a step of the merge (DivideSkip): probes of a search are made at once, steps one by one.
MU = 0.02


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for lo, hi in slices(texts):
        data, ends = text_bytes(texts.slice(lo, hi - lo))
        data = LOWER[data]
        starts, stops, bounds = words_of(data, ends)
        shingles, before = hash_windows(hash_spans(data, starts, stops), bounds, width)
        for a, b in zip(before[:-1], before[1:], strict=True):
            yield np.unique(shingles[a:b])


def set_key(s: np.ndarray) -> bytes:
    return np.array([mix(s + np.uint64(1)).sum(dtype=np.uint64), mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)], "<u8").tobytes()


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Of n shingles, how many any partner must share."""
    return -(-percent * n // 100)


def linked(overlap: int, n: int, m: int, percent: int = PERCENT) -> bool:
    return 100 * overlap >= percent * (n + m - overlap)


class Block:
    """Sets that meet, with their inverted index: tokens, where the list of each begins, and the sets in it."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.percent, self.sets = percent, sets
        self.sizes = np.array([len(s) for s in sets])
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")  # keeps the sets of a list in order
        self.tokens, first, rank = np.unique(tokens[order], return_index=True, return_inverse=True)
        self.starts, self.postings = np.append(first, len(tokens)), owner[order]
        self.keys = rank * np.int64(len(sets)) + self.postings  # sorted: for probes
        self.root = list(range(len(sets)))

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def search(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        """Sets before q that reach the overlap that any partner of q has, and their overlaps (DivideSkip)."""
        need = least_overlap(int(self.sizes[q]), self.percent)
        at = np.searchsorted(self.tokens, self.sets[q])
        length = self.starts[at + 1] - self.starts[at]
        order = np.argsort(length, kind="stable")
        apart = min(need - 1, int(need / (MU * math.log2(1 + int(length[order[-1]])) + 1)))
        short, long = at[order[: len(at) - apart]], at[order[len(at) - apart :]]
        lists = (self.postings[self.starts[t] : self.starts[t + 1]] for t in short)
        merged = heapq.merge(*(x[: np.searchsorted(x, q)].tolist() for x in lists))
        found = [(i, n) for i, same in groupby(merged) if (n := sum(1 for _ in same)) >= need - apart]
        sets, counts = np.array([i for i, _ in found], np.int64), np.array([n for _, n in found], np.int64)
        if len(sets) and apart:
            wanted = (long * np.int64(len(self.sets)))[:, None] + sets[None, :]
            place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            counts = counts + (self.keys[place] == wanted).sum(axis=0)
        keep = counts >= need
        return sets[keep], counts[keep]

    def links(self) -> Iterator[tuple[int, int]]:
        """Links that connect all sets that any links connect."""
        last: dict[int, int] = {}  # the latest set of each component
        for q in range(len(self.sets)):
            for p in sorted(last.values(), reverse=True)[:2]:
                if self.find(p) != self.find(q) and linked(len(np.intersect1d(self.sets[p], self.sets[q], assume_unique=True)), int(self.sizes[p]), int(self.sizes[q]), self.percent):
                    yield self._unite(q, p, last)
            if any(r != self.find(q) for r in last):
                sets, counts = self.search(q)
                good = 100 * counts >= self.percent * (self.sizes[q] + self.sizes[sets] - counts)
                for p in sets[good].tolist():
                    if self.find(p) != self.find(q):
                        yield self._unite(q, p, last)
            last[self.find(q)] = q

    def _unite(self, q: int, p: int, last: dict[int, int]) -> tuple[int, int]:
        a, b = self.find(q), self.find(p)
        last.pop(a, None)
        last.pop(b, None)
        self.root[a] = b
        last[b] = q
        return q, p


def _bits(docs: DataFrame) -> int:
    """Bits of a fingerprint that number a bucket: about a MB of input for each bucket, 2**8 to 2**20 buckets."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(20, max(8, math.ceil(math.log2(max(1, size) / 2**20)) if size > 2**20 else 8))


def frequent_fingerprints(base: DataFrame, bits: int, width: int) -> DataFrame:
    """bucket, fps (binary: sorted 32-bit numbers), tiers (binary: logarithms of their document frequency): at most FREQUENT fingerprints, the first 32 bits of shingles, those of each bucket with the most documents."""

    @lean
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0

        def out() -> pa.RecordBatch:
            fps, n = np.unique(np.concatenate(kept), return_counts=True)
            pieces = (n + 254) // 255  # a byte for each count; larger ones take several
            last = np.cumsum(pieces) - 1
            counts = np.full(pieces.sum(), 255, np.uint8)
            counts[last] = n - 255 * (pieces - 1)
            fps = np.repeat(fps, pieces)
            bucket = fps >> np.uint32(32 - bits)
            edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            stops = np.r_[edges[1:], len(fps)]
            low = fps.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]  # the bucket has the rest
            return pa.RecordBatch.from_arrays([pa.array(bucket[edges].astype(np.int32)), pa.array([low[a:b].tobytes() for a, b in zip(edges, stops, strict=True)], pa.binary()), pa.array([counts[a:b].tobytes() for a, b in zip(edges, stops, strict=True)], pa.binary())], ["bucket", "fps", "counts"])

        for batch in batches:
            for s in shingle_sets(column(batch, "text"), width):
                kept.append((s >> np.uint64(32)).astype(np.uint32))
                size += len(s)
            if size > 2_000_000:
                yield out()
                kept, size = [], 0
        if size:
            yield out()

    def frequent(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        low = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in rows.column("fps")]).reshape(-1, 3)
        n = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in rows.column("counts")]).astype(np.int64)
        fps = low[:, 0] + (low[:, 1].astype(np.int64) << 8) + (low[:, 2].astype(np.int64) << 16)
        fps, at = np.unique(fps, return_inverse=True)
        df = np.bincount(at, n).astype(np.int64)
        most = FREQUENT >> bits
        keep = np.flatnonzero(df > 1)
        keep = np.sort(keep[np.lexsort((keep, -df[keep]))[:most]])
        # bits above the third byte are the bucket's; where both have a bit, they agree
        fps = (fps[keep] | (np.int64(bucket) << (32 - bits))).astype("<u4")
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "fps": pa.array([fps.tobytes()], pa.binary()), "tiers": pa.array([np.log2(df[keep]).astype(np.int8).tobytes()], pa.binary())})

    return base.select("text").mapInArrow(counted, "bucket int, fps binary, counts binary").groupBy("bucket").applyInArrow(frequent, "bucket int, fps binary, tiers binary")


def _collected(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """FREQUENT numbers of 5 bytes at most; each row is let go when its bytes are copied."""
    rows = sorted(found.collect(), reverse=True)
    n = sum(len(r["tiers"]) for r in rows)
    fps, tiers, at = np.empty(n, "<u4"), np.empty(n, np.int8), 0
    while rows:
        r = rows.pop()
        stop = at + len(r["tiers"])
        fps[at:stop], tiers[at:stop] = np.frombuffer(r["fps"], "<u4"), np.frombuffer(r["tiers"], np.int8)
        at = stop
    return fps, tiers


def _prefixes(base: DataFrame, kind: str, hot: tuple[np.ndarray, np.ndarray], width: int, percent: int) -> DataFrame:
    """id, mark (a hash of the text), n, key, prefix: the rarest shingles of which any partner has one, tiers: the logarithm of their frequency if frequent."""
    shared = base.sparkSession.sparkContext.broadcast(hot)  # FREQUENT numbers at most
    del hot

    @lean
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fps, tiers = shared.value
        for batch in batches:
            n, keys, prefixes, tier_lists = [], [], [], []
            for s in shingle_sets(column(batch, "text"), width):
                fp = (s >> np.uint64(32)).astype(np.uint32)
                at = np.minimum(np.searchsorted(fps, fp), max(0, len(fps) - 1))
                tier = np.where(fps[at] == fp, tiers[at], 0) if len(fps) else np.zeros(len(s), np.int8)
                order = np.lexsort((s, tier))[: len(s) - least_overlap(len(s), percent) + 1 if len(s) else 0]
                n.append(len(s))
                keys.append(set_key(s))
                prefixes.append(s[order].view(np.int64))
                tier_lists.append(tier[order].astype(np.int8))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(keys, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(tier_lists, pa.list_(pa.int8()))], ["id", "mark", "n", "key", "prefix", "tiers"])

    return base.select("id", F.xxhash64("text").alias("mark"), "text").mapInArrow(made, f"id {kind}, mark long, n int, key binary, prefix array<long>, tiers array<tinyint>")


def _join_blocks(sets: DataFrame, percent: int) -> DataFrame:
    """a, b: links inside blocks (token and salt) that connect what any links connect."""

    @lean
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, held = None, [], []

        def out() -> pa.RecordBatch:
            found = list(Block(held, percent).links()) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([names[q] for q, _ in found], pa.int64()), pa.array([names[p] for _, p in found], pa.int64())], ["a", "b"])

        for batch in batches:
            for token, salt, c, tokens in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if (token, salt) != at:
                    if len(held) > 1:
                        yield out()
                    at, names, held = (token, salt), [], []
                names.append(c)
                held.append(np.frombuffer(tokens, "<u8"))
        yield out()

    grouped = sets.select(F.explode("blocks").alias("block"), "c", "tokens", "n").select("block.token", "block.salt", "c", "tokens", "n")
    return grouped.repartition("token", "salt").sortWithinPartitions("token", "salt", "n", "c").drop("n").mapInArrow(joined, "a long, b long")


def _blocks(lists: DataFrame) -> DataFrame:
    """c, blocks: array of (token, salt), of the most frequent lists that each class is in."""
    top = F.slice(F.sort_array(F.collect_list(F.struct("cnt", "token")), asc=False), 1, MEETINGS)  # no more than the class's prefix
    chosen = stored(lists.groupBy("c").agg(top.alias("top"), F.max("n").alias("n")).select("c", "n", F.explode("top.token").alias("token")), "chosen")
    parts = chosen.groupBy("token").agg(F.ceil(F.greatest(F.count(F.lit(1)) / GROUP, F.sum("n") / POSTINGS)).cast("long").alias("parts")).where("parts > 1")
    salted = chosen.join(_small(stored(parts, "parts")), "token", "left").select("c", F.struct("token", F.pmod(F.xxhash64("c"), F.coalesce("parts", F.lit(1))).alias("salt")).alias("block"))
    return salted.groupBy("c").agg(F.sort_array(F.collect_list("block")).alias("blocks"))


def _left_pairs(named: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of a list (c, n, root, blocks, token, cnt) that have met in no block, are in different components, and have sizes that allow a link."""

    @lean
    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def out() -> pa.RecordBatch:
            rows = held if len({r[1] for r in held}) > 1 else []  # one component: nothing is left
            c, root, n, tile = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2, 3))
            width = max((len(r[4]) for r in rows), default=0)
            blocks = np.full((len(rows), width, 2), -1, np.int64)
            for i, r in enumerate(rows):
                for j, block in enumerate(r[4]):
                    blocks[i, j] = block["token"], block["salt"]
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i in range(len(rows)):
                ok = (root[i + 1 :] != root[i]) & (100 * np.minimum(n[i + 1 :], n[i]) >= percent * np.maximum(n[i + 1 :], n[i]))
                if at[1] != at[2]:
                    ok &= tile[i + 1 :] != tile[i]
                later = np.flatnonzero(ok) + i + 1
                for token, salt in blocks[i][: len(rows[i][4])]:
                    later = later[~((blocks[later, :, 0] == token) & (blocks[later, :, 1] == salt)).any(axis=1)]
                a.append(np.minimum(c[i], c[later]))
                b.append(np.maximum(c[i], c[later]))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

        for batch in batches:
            for token, lo, hi, *row in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
                if (token, lo, hi) != at:
                    if len(held) > 1:
                        yield out()
                    at, held = (token, lo, hi), []
                held.append(row)
        if len(held) > 1:
            yield out()

    tiles = F.ceil(F.col("cnt") / TILE)
    tiled = named.withColumn("tile", F.pmod(F.xxhash64("c"), tiles)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
    tiled = tiled.select("token", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "c", "root", "n", "tile", "blocks")
    return tiled.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi").mapInArrow(paired, "a long, b long")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link."""

    @lean
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                keep.append(linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    x, y = (sets.select(F.col("c").alias(k), F.col("tokens").alias(f"tokens_{k}")) for k in "ab")
    return pairs.join(y, "b").join(x, "a").select("a", "b", "tokens_a", "tokens_b").mapInArrow(compared, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """id, n_shingles, component_id."""
    rows, labels = _join(docs, id_col, text_col, width, percent)
    named = rows.join(labels, "key", "left").select("id", "n", F.coalesce("component_id", "id").alias("component_id"))
    return named.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def _join(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, mark, n, key), and labels (key, root, component_id) of the sets that several rows have or that link."""
    spark = prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    rows = stored(_prefixes(base, kind, _collected(frequent_fingerprints(base, _bits(docs), width)), width, percent), "prefixes")
    classes = rows.where("n > 0").groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"), F.max(F.struct("prefix", "tiers")).alias("p"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("c"), "key", "id", "copies", "n", "p.prefix", "p.tiers"), "classes")

    lists = classes.select("c", "n", F.explode(F.arrays_zip("prefix", "tiers")).alias("t")).select("c", "n", F.col("t.prefix").alias("token"), F.col("t.tiers").alias("tier"))
    lists = lists.withColumn("cnt", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("cnt > 1")
    lists = stored(lists, "lists")

    owners = stored(_blocks(lists).join(classes.select("c", "id", "key"), "c").select("c", "id", "key", "blocks"), "owners")
    sets = stored(_sets_of(owners, base, width), "sets")
    if sets.count() > owners.count():  # rows repeated with their id
        sets = stored(sets.dropDuplicates(["c"]), "sets")

    links = stored(_join_blocks(sets, percent).distinct(), "near")
    roots = connected(links)
    marks = owners.select("c", "blocks").join(roots.select(F.col("node").alias("c"), "root"), "c", "left").select("c", "blocks", F.coalesce("root", "c").alias("root"))
    named = lists.select("token", "c", "n", "cnt").join(_small(stored(marks, "marks")), "c")
    pairs = _left_pairs(named, percent).distinct()
    more = stored(_compare(stored(pairs, "pairs"), sets, percent), "more")

    roots = connected(links.unionByName(more))
    small = classes.select("c", "key", "id", "copies").join(roots.select(F.col("node").alias("c"), "root"), "c", "left").where("copies > 1 or root is not null").select("key", "id", F.coalesce("root", "c").alias("root"))
    small = stored(small, "members")
    names = small.groupBy("root").agg(F.min("id").alias("component_id"))
    return rows.select("id", "mark", "n", "key"), stored(small.join(names, "root").select("key", "root", "component_id"), "labels")


def _sets_of(owners: DataFrame, base: DataFrame, width: int) -> DataFrame:
    """owners with n and tokens, the whole sets of their classes, from the text of the row with the class's id."""
    wanted = _small(owners.select("c", F.col("id").alias("own"), "key", "blocks"))
    joined = base.join(wanted, F.col("id").eqNullSafe(F.col("own"))).select("text", "c", "key", "blocks")

    @lean
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(column(batch, "text"), width))
            keep = pa.array([set_key(s) == key for s, key in zip(sets, batch.column(2).to_pylist(), strict=True)], pa.bool_())
            columns = [batch.column(1), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, ["c", "n", "tokens", "blocks"]).filter(keep)

    return joined.mapInArrow(made, "c long, n int, tokens binary, blocks array<struct<token: long, salt: long>>")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with all its columns: that with the smallest id (no id comes last), then text hash.

    Documents without words stay. Rows that agree in id and text are one document: of several, the one whose other columns
    come first as JSON text stays.
    """
    rows, labels = _join(docs, id_col, text_col, width, percent)
    group = F.coalesce(F.col("root").cast("string"), F.hex("key"))
    first = rows.where("n > 0").join(labels, "key", "left").groupBy(group.alias("g")).agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("first"))
    chosen = stored(first.select("first.id", "first.mark").unionByName(rows.where("n = 0").select("id", "mark").distinct()), "chosen")
    kept_id, kept_mark = unlike(docs.columns, "kept_id"), unlike(docs.columns, "kept_mark")
    wanted = chosen.select(F.col("id").alias(kept_id), F.col("mark").alias(kept_mark))
    if chosen.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = docs.join(wanted, F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.xxhash64(text) == F.col(kept_mark)), "left_semi")
    if rows.select("id", "mark").distinct().count() == rows.count():
        return kept
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")  # a row for each id and text
    least = kept.groupBy(F.col(id_col).alias("i"), F.xxhash64(text).alias("m")).agg(F.min_by(whole, F.to_json(whole)).alias("whole"))
    return least.select("whole.*")
