"""Samples and folds that depend on keys alone: the same rows on every run and any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of the order of keys, and codes in a range of codes, that are numbered apart.
CELLS, CODES = 4096, 65536


def key_hash(key: Column, seed: int = 0) -> Column:
    """An order of keys by integer arithmetic that any SQL engine can repeat."""
    return F.pmod(F.pmod(key, F.lit(1_000_003)) * F.lit(2654435761) + F.lit(seed), F.lit(1_000_003))


def key_cell(key: Column, seed: int = 0) -> Column:
    """One of CELLS ranges of the order of keys."""
    return F.floor(key_hash(key, seed) * CELLS / 1_000_003)


def numbered(rows: DataFrame, by: list[str], cell: Column, order: list, place: str, size: str | None = None) -> DataFrame:
    """place: from 1 on, the place of a row in its group; size: the rows of the group.

    Cells follow the order. They are counted first, summed up before the shuffle, and rows are numbered within a cell from the
    count of the cells before it: a large group is never one task.
    """
    marked = rows.withColumn("_cell", cell)
    counts = marked.groupBy(*by, "_cell").agg(F.count(F.lit(1)).alias("_in"))
    group = Window.partitionBy(*by)  # a row for each cell
    before = F.sum("_in").over(group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(*(F.col(c).alias(f"_{c}_") for c in by), F.col("_cell").alias("_at"), F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_in").over(group).alias("_size"))
    same = F.col("_cell").eqNullSafe(F.col("_at"))
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}_"))
    within = F.row_number().over(Window.partitionBy(*by, "_cell").orderBy(*order))
    out = marked.join(starts, same).withColumn(place, within + F.col("_before"))
    return out.select(*rows.columns, place, *([F.col("_size").alias(size)] if size else []))


def folds(entities: DataFrame, strata: list[str], key: str, n: int = 5, seed: int = 0) -> DataFrame:
    """fold: entities of a stratum dealt out in turn."""
    dealt = numbered(entities, strata, key_cell(F.col(key), seed), [key_hash(F.col(key), seed), key], "_r")
    return dealt.withColumn("fold", F.pmod(F.col("_r") - 1, F.lit(n)).cast("int")).drop("_r")


def stratified_sample(entities: DataFrame, strata: list[str], key: str, fraction: float, seed: int = 0) -> DataFrame:
    """round(fraction * size) rows of each stratum, exactly."""
    ranked = numbered(entities, strata, key_cell(F.col(key), seed), [key_hash(F.col(key), seed), key], "_r", "_n")
    return ranked.where(F.col("_r") <= F.floor(F.col("_n") * fraction + 0.5)).drop("_r", "_n")


def uniform_sample(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """The n rows whose keys come first: a top-n, no full sort."""
    return rows.orderBy(key_hash(F.col(key), seed), key).limit(n)


def random_negatives(positives: DataFrame, pool: DataFrame, seed: int = 0) -> DataFrame:
    """For each pair (country, s1, cand) one record (country, code) of the same country."""
    dealt = numbered(pool.select("country", "code"), ["country"], F.floor(F.col("code") / CODES), ["code"], "at").withColumn("at", F.col("at") - 1)
    sizes = pool.groupBy("country").agg(F.count(F.lit(1)).alias("size"))
    want = positives.join(F.broadcast(sizes), "country").withColumn("at", F.pmod(key_hash(F.col("s1") + F.col("cand"), seed), F.col("size")))
    return want.join(dealt, ["country", "at"]).select("country", "s1", F.col("code").alias("cand"))


def disjoint(entities: DataFrame, strata: list[str], key: str, fractions: dict[str, float], seed: int = 0) -> DataFrame:
    """set: named samples without common rows; each is drawn from what the earlier ones left."""
    left, out = entities, None
    for k, (name, fraction) in enumerate(fractions.items()):
        part = stratified_sample(left, strata, key, fraction, seed + k).withColumn("set", F.lit(name))
        out = part if out is None else out.unionByName(part)
        left = left.join(part.select(key), key, "left_anti")
    return out
