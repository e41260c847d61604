"""Profiles of record tables: rates by group, quantiles, counts of tokens and duplicates, integrity."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.transliterate import unicode_script

QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)


def group_rates(df: DataFrame, group: str, flags: dict[str, Column]) -> DataFrame:
    """Share of rows with each flag, for each group and for all rows (ALL)."""
    base = df.select(group, *(c.cast("int").alias(k) for k, c in flags.items()))
    rates = base.rollup(group).agg(F.grouping(group).alias("_all"), F.count(F.lit(1)).alias("n"), *(F.round(F.avg(k), 6).alias(k) for k in flags))
    return rates.withColumn(group, F.when(F.col("_all") == 1, "ALL").otherwise(F.col(group))).drop("_all")


def quantiles(df: DataFrame, value: Column, group: str | None = None) -> DataFrame:
    """mean and p1 to p100, exact, linear between values."""
    base = df.select(*([group] if group else []), value.cast("double").alias("v"))
    aggs = [F.avg("v").alias("mean"), F.percentile("v", F.array(*(F.lit(q) for q in QUANTILES))).alias("q")]
    out = base.groupBy(group).agg(*aggs) if group else base.agg(*aggs)
    return out.select(*([group] if group else []), "mean", *(F.col("q")[i].alias(f"p{round(q * 100)}") for i, q in enumerate(QUANTILES)))


def duplicate_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """distinct_keys, rows_in_duplicates, extra_rows."""
    c = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    return c.agg(F.count(F.lit(1)).alias("distinct_keys"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), zero).alias("rows_in_duplicates"), F.coalesce(F.sum(F.col("n") - 1), zero).alias("extra_rows"))


def token_counts(df: DataFrame, toks: Column, group: str | None = None) -> DataFrame:
    by = [group] if group else []
    return df.select(*by, F.explode(toks).alias("token")).groupBy(*by, "token").agg(F.count(F.lit(1)).alias("n"))


def top_n(counts: DataFrame, n: int, group: str | None = None, key: str = "token") -> DataFrame:
    """The n largest counts (of each group), ties by key."""
    if not group:
        return counts.orderBy(F.col("n").desc(), key).limit(n)
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.col("n").desc(), key))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n)


def shares(counts: DataFrame, group: str | None = None) -> DataFrame:
    by = [group] if group else []
    totals = counts.groupBy(*by).agg(F.sum("n").alias("_total")) if group else counts.agg(F.sum("n").alias("_total"))
    both = counts.join(totals, by) if group else counts.crossJoin(F.broadcast(totals))  # one row of totals
    return both.withColumn("share", F.round(F.col("n") / F.col("_total"), 6)).drop("_total")


def histogram(df: DataFrame, value: Column, edges: list[float]) -> DataFrame:
    """bin (its upper edge), n: bins are open below and closed above; values outside have none."""
    bin_of = None
    for lo, hi in zip(edges, edges[1:], strict=False):
        cond = (value > lo) & (value <= hi)
        bin_of = F.when(cond, F.lit(float(hi))) if bin_of is None else bin_of.when(cond, F.lit(float(hi)))
    return df.select(bin_of.alias("bin")).where("bin is not null").groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def integrity(frame: DataFrame, id_col: str, prefix: str, country: str = "country") -> DataFrame:
    """n, duplicate_ids, bad_prefix, empty_id, empty_country."""
    c = F.col(id_col)
    empty = lambda x: F.coalesce(x, F.lit("")) == ""
    flags = frame.agg(F.count(F.lit(1)).alias("n"), F.count_if(~empty(c) & ~c.startswith(prefix)).alias("bad_prefix"), F.count_if(empty(c)).alias("empty_id"), F.count_if(empty(F.col(country))).alias("empty_country"))
    return flags.crossJoin(duplicate_counts(frame, [id_col]).select(F.col("extra_rows").alias("duplicate_ids")))  # one row each


def truth_integrity(truth: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    """Counts over (s1, cand): rows, entities, unknown ones on both sides, repeated pairs, candidates with several entities, entities without a row."""
    one = truth.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("s1").alias("entities"))
    parts = [
        truth.join(s1.select("s1").distinct(), "s1", "left_anti").agg(F.count(F.lit(1)).alias("unknown_s1")),
        truth.join(others.select("cand").distinct(), "cand", "left_anti").agg(F.count(F.lit(1)).alias("unknown_cand")),
        duplicate_counts(truth, ["s1", "cand"]).select(F.col("extra_rows").alias("repeated_pairs")),
        truth.select("s1", "cand").distinct().groupBy("cand").count().where("count > 1").agg(F.count(F.lit(1)).alias("shared_cand")),
        s1.select("s1").distinct().join(truth.select("s1").distinct(), "s1", "left_anti").agg(F.count(F.lit(1)).alias("s1_without_match")),
    ]
    for p in parts:
        one = one.crossJoin(p)  # one row each
    return one


def pair_space(rec: DataFrame, truth: DataFrame) -> DataFrame:
    """In-country pairs by arithmetic, the full product, positives, negatives for each positive."""
    c = rec.groupBy("country").agg(F.count_if(F.col("source") == 1).alias("n1"), F.count_if(F.col("source") != 1).alias("n23"))
    out = c.agg(F.sum(F.col("n1") * F.col("n23")).alias("same_country"), (F.sum("n1") * F.sum("n23")).alias("full_product"))
    pos = truth.agg(F.count(F.lit(1)).alias("positives"))
    ratio = F.when(F.col("positives") > 0, F.round((F.col("same_country") - F.col("positives")) / F.col("positives"), 6))
    return out.crossJoin(pos).withColumn("negatives_per_positive", ratio)  # one row each


def source_mix(cards: DataFrame) -> DataFrame:
    """Entities with matches of source 2 only, 3 only, both, none: cards has (s1, n2, n3)."""
    a, b = F.col("n2") > 0, F.col("n3") > 0
    return cards.agg(F.count_if(a & ~b).alias("only_s2"), F.count_if(~a & b).alias("only_s3"), F.count_if(a & b).alias("both"), F.count_if(~a & ~b).alias("none"))


def script_counts(df: DataFrame, text: str) -> DataFrame:
    """script, rows_with, n_chars: texts are counted where they are read, so that a partition sends one row for each script."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: Counter[str] = Counter()
        chars: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0):
                here: Counter[str] = Counter()
                for ch, n in Counter(value.as_py() or "").items():
                    here[unicode_script(ch)] += n
                rows.update(here.keys())
                chars.update(here)
        yield pa.RecordBatch.from_arrays([pa.array(list(chars), pa.string()), pa.array([rows[k] for k in chars], pa.int64()), pa.array(list(chars.values()), pa.int64())], ["script", "rows_with", "n_chars"])

    parts = df.select(text).mapInArrow(count, "script string, rows_with long, n_chars long")
    return parts.groupBy("script").agg(F.sum("rows_with").alias("rows_with"), F.sum("n_chars").alias("n_chars"))
