"""Token equivalences and weak tokens, mined from names and labelled pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import ratio_col
from ..functions.text import abbreviation_compatible
from .components import connected

#: Least shares and rates of weak tokens, least counts, consistency and ratio of substitutions.
SUFFIX_SHARE, SUFFIX_LAST, UNSTABLE_SHARE, UNSTABLE_RATE, SUB_COUNT, SUB_CONSISTENCY, SUB_RATIO = 0.003, 0.6, 0.002, 0.5, 25, 0.5, 70.0


def suffix_tokens(names: DataFrame, min_share: float = SUFFIX_SHARE, min_last_ratio: float = SUFFIX_LAST) -> DataFrame:
    """country, token of (country, toks): tokens that often end a name and are seldom elsewhere."""
    n = names.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    full = names.where(F.size("toks") > 0)
    last = full.groupBy("country", F.try_element_at("toks", F.lit(-1)).alias("token")).agg(F.count(F.lit(1)).alias("last"))
    anywhere = full.select("country", F.explode(F.array_distinct("toks")).alias("token")).groupBy("country", "token").agg(F.count(F.lit(1)).alias("anywhere"))
    joined = last.join(anywhere, ["country", "token"]).join(F.broadcast(n), "country")  # a row for each country
    return joined.where((F.col("last") / F.col("n") >= min_share) & (F.col("last") / F.col("anywhere") >= min_last_ratio)).select("country", "token")


def instability_tokens(pairs: DataFrame, min_share: float = UNSTABLE_SHARE, min_rate: float = UNSTABLE_RATE) -> DataFrame:
    """country, token, rate of (country, a_toks, b_toks): common tokens that are often on one side of a true pair only."""
    n = pairs.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select("country", F.explode(F.array_union("a_toks", "b_toks")).alias("token"), "a_toks", "b_toks")
    seen = sides.select("country", "token", (~(F.array_contains("a_toks", F.col("token")) & F.array_contains("b_toks", F.col("token")))).cast("int").alias("one"))
    counts = seen.groupBy("country", "token").agg(F.count(F.lit(1)).alias("either"), F.sum("one").alias("one")).join(F.broadcast(n), "country")
    enough = F.col("either") >= F.greatest(F.lit(1), F.floor(min_share * F.col("n")))
    return counts.where(enough & (F.col("one") / F.col("either") >= min_rate)).select("country", "token", F.round(F.col("one") / F.col("either"), 4).alias("rate"))


def count_substitutions(pairs: DataFrame) -> DataFrame:
    """country, m, s, n: match token m for token s where sides differ by one token each."""
    diff = pairs.select("country", F.array_except("a_toks", "b_toks").alias("da"), F.array_except("b_toks", "a_toks").alias("db")).where("size(da) = 1 and size(db) = 1")
    return diff.groupBy("country", F.try_element_at("db", F.lit(1)).alias("m"), F.try_element_at("da", F.lit(1)).alias("s")).agg(F.count(F.lit(1)).alias("n"))


def accept_substitutions(subs: DataFrame, min_count: int = SUB_COUNT, min_consistency: float = SUB_CONSISTENCY, min_ratio: float = SUB_RATIO) -> DataFrame:
    """Frequent, consistent and plausible substitutions."""
    total = F.sum("n").over(Window.partitionBy("country", "m"))
    digits = F.col("m").rlike("^[0-9]+$") | F.col("s").rlike("^[0-9]+$")
    likely = subs.withColumn("total", total).where((F.col("n") >= min_count) & ~digits & (F.col("n") / F.col("total") >= min_consistency))
    scored = likely.withColumn("ratio", ratio_col(F.col("m"), F.col("s")))
    return scored.where(abbreviation_compatible(F.col("m"), F.col("s")) | (F.col("ratio") >= min_ratio)).select("country", "m", "s", "n")


def build_map(accepted: DataFrame, freq: DataFrame) -> DataFrame:
    """country, token, canon: tokens of an equivalence class to its most frequent one (freq: country, token, n); ties by length, then text."""
    node = lambda token: F.struct("country", F.col(token).alias("token"))
    classes = connected(accepted.select(node("m").alias("a"), node("s").alias("b")))
    labels = classes.select("node.country", "node.token", F.col("root.token").alias("label"))
    ranked = labels.join(freq, ["country", "token"], "left").withColumn("k", F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.char_length("token").alias("l"), F.col("token").alias("t")))
    canon = ranked.groupBy("country", "label").agg(F.max("k").alias("k"))
    return labels.join(canon, ["country", "label"]).select("country", "token", F.col("k.t").alias("canon")).where("token <> canon")


def mine_token_maps(pairs: DataFrame, freq: DataFrame, **limits: float) -> DataFrame:
    """Counts, accepts and classes in one: country, token, canon."""
    return build_map(accept_substitutions(count_substitutions(pairs), **limits), freq)


def weak_tokens(mined: DataFrame, suffixes: DataFrame) -> DataFrame:
    """country, token: the union of both."""
    return mined.select("country", "token").unionByName(suffixes.select("country", "token")).distinct()
