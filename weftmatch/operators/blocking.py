"""Retrieval: TF-IDF weights in long form and exact top-k cosine.

Tokens are rows (country, code, source, field, token), or such rows once for each record with their count tf. Frequent tokens
are left out before any join, so that no list is longer than max_df of a country's records; pairs that share a token meet in
memory, see nearest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..sources.store import stored
from .nearest import nearest

#: Blocks, their lists per query and their pruning.
BLOCK_K = {"fielded": 30, "addr": 15, "name_char": 15, "name_word": 10}
BLOCK_MAX_DF = {"fielded": 0.02, "addr": 0.02, "name_word": 0.02, "name_char": 0.01}
BLOCK_FIELDS = {"fielded": ("name", "addr", "num"), "addr": ("addr", "num"), "name_word": ("name",)}
RECORD = ["country", "code", "source"]
KEYS = ["country", "field", "token"]
#: Tokens that are counted at once.
AT_ONCE = 1_000_000


def field_tokens(rec: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """One row for each occurrence of a token: fields maps a name to an expression of array<string>."""
    parts = F.array(*(F.struct(F.lit(name).alias("field"), c.alias("tokens")) for name, c in fields.items()))
    return rec.select(*RECORD, F.explode(parts).alias("f")).select(*RECORD, F.col("f.field").alias("field"), F.explode("f.tokens").alias("token"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy(zero_copy_only=False))
        a = 0
        while a < len(ends):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + AT_ONCE, "right")))
            part = batch.slice(a, b - a)
            words = part.column("tokens").flatten().dictionary_encode()
            row = np.repeat(np.arange(b - a), np.diff(ends[a:b], prepend=ends[a - 1] if a else 0))
            n = max(1, len(words.dictionary))
            key, tf = np.unique(row * n + words.indices.to_numpy(zero_copy_only=False), return_counts=True)
            at = pa.array(key // n)
            yield pa.RecordBatch.from_arrays([*(part.column(c).take(at) for c in (*RECORD, "field")), words.dictionary.take(pa.array(key % n)), pa.array(tf, pa.int64())], [*RECORD, "field", "token", "tf"])
            a = b


def field_counts(rec: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """One row for each token of a record's field, with its count tf; counted beside the text, so that only rows of one record given twice are shuffled."""
    parts = F.array(*(F.struct(F.lit(name).alias("field"), c.alias("tokens")) for name, c in fields.items()))
    lists = rec.select(*RECORD, F.explode(parts).alias("f")).select(*RECORD, "f.field", "f.tokens")
    if not rec.groupBy(*RECORD).count().where("count > 1").isEmpty():
        lists = lists.groupBy(*RECORD, "field").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))
    token = lists.schema["tokens"].dataType.elementType
    return lists.mapInArrow(_counted, StructType([*(lists.schema[c] for c in (*RECORD, "field")), StructField("token", token), StructField("tf", LongType())]))


def country_sizes(rec: DataFrame) -> DataFrame:
    return rec.groupBy("country").agg(F.count(F.lit(1)).alias("n"))


def idf(df: Column, n: Column) -> Column:
    return F.log((n + 1) / (df + 1)) + 1


def _weighed(tf: DataFrame, counts: DataFrame, max_df: float) -> DataFrame:
    """Rows of tf that a kept token of counts (country, field, token, df, n, ...) has, with its columns and an id. Only rows of kept tokens are shuffled: those of frequent ones are most of a text, but few tokens, at most a record's tokens / max_df in a country."""
    often = counts.where(F.col("df") > max_df * F.col("n")).select(*KEYS)
    kept = stored(counts.where(F.col("df") <= max_df * F.col("n")).withColumn("id", F.monotonically_increasing_id()), "kept")
    sizes = {r["p"]: r["count"] for r in kept.groupBy(F.shiftright("id", 33).alias("p")).count().collect()}  # ids without gaps are half as long
    total, first = 0, []
    for p in range(max(sizes, default=-1) + 1):
        first.append(total)
        total += sizes.get(p, 0)
    dense = F.array(*map(F.lit, first or [0]))[F.shiftright("id", 33).cast("int")] + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    kept = kept.withColumn("id", dense.cast("int" if total < 1 << 31 else "long"))
    return tf.join(F.broadcast(often), KEYS, "left_anti").join(kept, KEYS)


def tfidf_weights(tok: DataFrame, sizes: DataFrame, max_df: float = 0.02, min_df: int = 2, scale: dict[str, float] | None = None, unit: bool = True) -> DataFrame:
    """Unit vectors: (1 + ln tf) * idf of tokens in min_df records or more and at most max_df of the country's; scale: weights of fields, after which vectors are made unit. tok: tokens, or counts of field_counts. Without unit, vectors of the same direction."""
    tf = tok if "tf" in tok.columns else stored(tok.groupBy(*RECORD, "field", "token").agg(F.count(F.lit(1)).alias("tf")), "tf")  # texts are read once
    df = stored(tf.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df), "df")
    w = _weighed(tf, df.join(F.broadcast(sizes), "country"), max_df).withColumn("w", (1 + F.log("tf")) * idf(F.col("df"), F.col("n")))  # one row for each country
    if scale and any(x != 1.0 for x in scale.values()):
        factor = F.coalesce(*(F.when(F.col("field") == k, F.lit(x)) for k, x in scale.items()), F.lit(1.0))
        w = w.withColumn("w", F.col("w") * factor)
    return (_unit(w) if unit else w).select(*RECORD, "field", "token", "id", "w")


def _unit(w: DataFrame) -> DataFrame:
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("country", "code")))
    return w.withColumn("w", F.col("w") / norm)


def field_statistics(tok: DataFrame, sizes: DataFrame) -> DataFrame:
    """country, field, token, df, n, idf over the records of a country."""
    each = tok if "tf" in tok.columns else tok.select("country", "code", "field", "token").distinct()
    df = each.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("df"))
    return df.join(F.broadcast(sizes), "country").withColumn("idf", idf(F.col("df"), F.col("n")))


def block_weights(tok: DataFrame, stats: DataFrame, fields: tuple[str, ...], max_df: float, weak: DataFrame | None = None, unit: bool = True) -> DataFrame:
    """Unit vectors of a block: idf of distinct tokens, none for frequent ones, nor for weak name tokens (country, token) if given. Without unit, vectors of the same direction."""
    kept = stats.where(F.col("field").isin(*fields))
    if weak is not None:
        kept = kept.join(weak.select("country", "token", F.lit("name").alias("field")), KEYS, "left_anti")
    each = tok.where(F.col("field").isin(*fields)).select(*RECORD, "field", "token")
    w = _weighed(each if "tf" in tok.columns else each.distinct(), kept, max_df).withColumn("w", F.col("idf"))
    return (_unit(w) if unit else w).select(*RECORD, "field", "token", "id", "w")


def topk(weights: DataFrame, k: int, min_score: float = 0.0, query_source: int = 1) -> DataFrame:
    """q, c, score, rank: for each record of the query source its k best records of other sources by cosine; ties by id."""
    return nearest(weights, k, min_score, query_source)


def generate_candidates(blocks: dict[str, DataFrame]) -> DataFrame:
    """q, c, rank_<block> (-1 if absent), n_blocks: the distinct union of ranked blocks."""
    parts = None
    for name, b in blocks.items():
        one = b.select("q", "c", F.lit(name).alias("block"), "rank")
        parts = one if parts is None else parts.unionByName(one)
    ranks = [F.coalesce(F.min(F.when(F.col("block") == name, F.col("rank"))), F.lit(-1)).alias(f"rank_{name}") for name in blocks]
    return parts.groupBy("q", "c").agg(*ranks, F.count_distinct("block").alias("n_blocks"))


def block_membership(cands: DataFrame, block: str, k: int | None = None) -> DataFrame:
    r = F.col(f"rank_{block}")
    return cands.where((r >= 0) & (r < k) if k is not None else r >= 0)


def restrict(cands: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Pairs within the limit of any block; ranks beyond become 99, n_blocks is counted again."""
    inside = {b: (F.col(f"rank_{b}") >= 0) & (F.col(f"rank_{b}") < k) for b, k in limits.items()}
    any_of = None
    for x in inside.values():
        any_of = x if any_of is None else any_of | x
    ranks = [F.when(x, F.col(f"rank_{b}")).otherwise(99).alias(f"rank_{b}") for b, x in inside.items()]
    count = sum((x.cast("int") for x in inside.values()), F.lit(0))
    return cands.where(any_of).select("q", "c", *ranks, count.alias("n_blocks"))


def pair_cosine(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """q, c, cosine of given pairs; 0 if they share no weighted token."""
    a = weights.select(F.col("code").alias("q"), "field", "token", F.col("w").alias("wq"))
    b = weights.select(F.col("code").alias("c"), "field", "token", F.col("w").alias("wc"))
    ids = pairs.select("q", "c").distinct()
    dots = ids.join(a, "q").join(b, ["c", "field", "token"]).groupBy("q", "c").agg(F.sum(F.col("wq") * F.col("wc")).alias("cosine"))
    return ids.join(dots, ["q", "c"], "left").withColumn("cosine", F.coalesce("cosine", F.lit(0.0)))


def shared_weight(pairs: DataFrame, tok: DataFrame, stats: DataFrame) -> DataFrame:
    """q, c, field, n_shared, idf_shared, idf_max of given pairs: over their common distinct tokens."""
    d = tok.select("country", "code", "field", "token").distinct()
    a, b = d.select("country", F.col("code").alias("q"), "field", "token"), d.select(F.col("code").alias("c"), "field", "token")
    common = pairs.select("q", "c").distinct().join(a, "q").join(b, ["c", "field", "token"]).join(stats.select("country", "field", "token", "idf"), ["country", "field", "token"])
    return common.groupBy("q", "c", "field").agg(F.count(F.lit(1)).alias("n_shared"), F.sum("idf").alias("idf_shared"), F.max("idf").alias("idf_max"))
