"""Pair features: 85 columns for candidate pairs (q, c) with ranks of blocks.

Ids of records' tokens are joined to both sides and summed over by a Java function, then attributes are; string scores are
another Java function. Columns of sums that nothing matches are 0.
"""

from __future__ import annotations

import zlib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from ..functions import jvm
from ..functions import text as T
from . import blocking as B
from ..sources.store import drop, stored
from .policy import context

#: Pairs of a task.
TASK = 1000
CONTEXT = ["fielded_cos", "name_char_cos", "addr_cos", "name_tset"]


def name_attributes(name: Column, weak: Column | None = None) -> dict[str, Column]:
    """Token arrays of a normalised name."""
    weak = F.array().cast("array<string>") if weak is None else weak
    every = T.tokens(name)
    core = T.core_tokens(every, weak)
    return {"core_all": core, "name_core": T.joined(core), "name_t": F.array_distinct(every), "core_t": F.filter(F.array_distinct(every), lambda t: ~F.array_contains(weak, t) & ~t.isin(*T.STOPWORDS))}


def attributes(rec: DataFrame, weak: DataFrame | None = None) -> DataFrame:
    """Token arrays and flags of records (country, code, source, name_raw, addr_raw, name_norm, addr_norm)."""
    out = rec.withColumn("name_all", T.tokens(F.col("name_norm"))).withColumn("said", _said())
    if weak is not None:
        lists = weak.groupBy("country").agg(F.collect_set("token").alias("weak"))  # a bounded list: tokens in a given share of names
        out = out.join(lists, "country", "left").withColumn("weak", F.coalesce("weak", F.array().cast("array<string>")))
    else:
        out = out.withColumn("weak", F.array().cast("array<string>"))
    out = out.withColumn("core_all", T.core_tokens(F.col("name_all"), F.col("weak"))).withColumn("nums_all", T.numbers(F.col("addr_raw")))
    out = out.withColumn("name_core", T.joined(F.col("core_all"))).withColumn("name_t", F.array_distinct("name_all")).withColumn("addr_t", F.array_distinct(T.tokens(F.col("addr_norm")))).withColumn("num_t", F.array_distinct("nums_all"))
    out = out.withColumn("core_t", F.filter("name_t", lambda t: ~F.array_contains(F.col("weak"), t) & ~t.isin(*T.STOPWORDS))).withColumn("comp_t", F.array_distinct(T.components(F.col("addr_raw"))))
    return out.drop("weak", "name_all")


def _said() -> Column:
    """What tells records of one code apart."""
    return _hash(F.concat_ws("\n", F.coalesce(F.concat(F.lit("-"), "country"), F.lit("")), "name_norm", "addr_norm"))


def _hash(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _generic(rec: DataFrame) -> DataFrame:
    """code, said, name_generic, addr_generic: how often a country's records have that name or address. Texts are read once and meet by their SHA-256; an empty address counts as nothing."""
    filled = F.when(F.col("addr_norm") != "", F.col("addr_norm"))
    rows = stored(rec.select("code", "country", "said", _hash(F.col("name_norm")).alias("name"), _hash(filled).alias("addr")), "said")
    out = rows.distinct()
    for field in ("name", "addr"):  # counts are summed up before a shuffle
        counts = rows.where(F.col(field).isNotNull()).groupBy("country", field).agg(F.log1p(F.count(F.lit(1)).cast("double")).alias(f"{field}_generic"))
        out = out.join(counts, ["country", field], "left").withColumn(f"{field}_generic", F.coalesce(f"{field}_generic", F.lit(0.0)))
    return out.select("code", "said", "name_generic", "addr_generic")


@F.pandas_udf(BinaryType())
def _pack(first: pd.Series, second: pd.Series) -> pd.Series:
    return pd.Series([zlib.compress("\n".join(" ".join(sorted(set(t.split(" ")) - {""})) for t in (x, y)).encode(), 1) for x, y in zip(first, second, strict=True)])


@F.pandas_udf(StructType([StructField(c, LongType()) for c in ("first", "first_either", "second", "second_either")]))
def _pack_common(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    out, known = [], ("", [set(), set()])
    opened = lambda x: [set(t.split(" ")) - {""} for t in zlib.decompress(x).decode().split("\n")]
    for x, y in zip(a, b, strict=True):
        if y != known[0]:  # pairs of one best candidate stand together
            known = (y, opened(y))
        row = []
        for s, t in zip(opened(x), known[1], strict=True):
            row += [n := len(s & t), len(s) + len(t) - n]
        out.append(row)
    return pd.DataFrame(out, columns=["first", "first_either", "second", "second_either"], dtype="int64")


def packed(first: Column, second: Column) -> Column:
    """Two sets of tokens in few bytes, to travel beside pairs; a token holds no white space."""
    return _pack(T.joined(first), T.joined(second))  # a text a row: lists of tokens are many times as large in Python


def packed_common(a: Column | str, b: Column | str) -> Column:
    """first, first_either, second, second_either: how many tokens both packed records have, and either."""
    return _pack_common(a, b)


SCORES = ("name_ratio", "core_ratio", "name_jw", "core_dl", "name_tsort", "name_tset", "core_partial", "addr_ratio", "addr_tset", "addr_tsort", "addr_common")

SUMS = ("core_sum", "core_top", "addr_sum", "num_sum", "fielded_cos", "addr_cos", "name_word_cos")


def scores(spark: SparkSession, a: str, b: str) -> Column:
    """SCORES of the texts of two sides, in one function; ratios from 0 to 100, addr_common: the number of common tokens."""
    texts = [f"{side}.{text}" for text in ("name_norm", "name_core", "addr_norm") for side in (a, b)]
    return jvm.function(spark, "Scores", ArrayType(DoubleType()))(*texts)


def _lean(attrs: DataFrame) -> DataFrame:
    """What pairs need of records: flags instead of raw texts, hashes of components, sets of tokens packed."""
    flags = {f"name_{k}": T.flag(F.col("name_raw"), p) for k, p in (("nonascii", T.NAME_PATTERNS["non_ascii"]), ("domain", T.NAME_PATTERNS["domain_name"] + r"|(?i)\bwww\b"), ("alias", T.NAME_PATTERNS["alias_marker"]))}
    flags["addr_nonascii"] = T.flag(F.col("addr_raw"), T.ADDR_PATTERNS["non_ascii"])
    flags = {k: v.cast("double").alias(k) for k, v in flags.items()}
    comp = F.transform("comp_t", lambda t: F.xxhash64(t)).alias("comp_t")
    return attrs.select(*B.RECORD, "name_norm", "addr_norm", "core_all", "nums_all", "name_core", "name_t", "core_t", "num_t", comp, "said", F.size("addr_t").alias("addr_n"), packed(F.col("name_t"), F.col("addr_t")).alias("sets"), *flags.values())


def tokens_of(attrs: DataFrame) -> DataFrame:
    return B.field_tokens(attrs, {"name": F.col("name_t"), "core": F.col("core_t"), "addr": F.col("addr_t"), "num": F.col("num_t")})


def char_weights(attrs: DataFrame, max_df: float = B.BLOCK_MAX_DF["name_char"], unit: bool = True) -> DataFrame:
    grams = F.flatten(F.transform(T.tokens(F.col("name_norm")), lambda w: T.char_ngrams(w)))
    return B.tfidf_weights(B.field_counts(attrs, {"char": grams}), B.country_sizes(attrs), max_df, unit=unit)


def vectors(tok: DataFrame, stats: DataFrame, limits: dict[str, float]) -> DataFrame:
    """code, vec, core_total, addr_total: of each country of a code the ids of its tokens by field and their df, which Sums.java reads, with the norms of three blocks. An id stands for a token of any country."""
    ids = stored(stats.select("token").union(tok.where("country is null").select("token")).distinct().withColumn("id", F.monotonically_increasing_id()), "ids")
    alone = tok.where("country is null").select(*B.KEYS).distinct()  # without statistics, but common to others
    known = stats.unionByName(alone.select("*", *(F.lit(None).cast(stats.schema[c].dataType).alias(c) for c in ("df", "n", "idf")))).join(ids, "token")
    each = tok.select("country", "code", "field", "token").alias("t").join(known.alias("k"), F.col("t.country").eqNullSafe(F.col("k.country")) & (F.col("t.field") == F.col("k.field")) & (F.col("t.token") == F.col("k.token")))
    each = each.select("t.country", "t.code", "t.field", "k.id", "k.df", "k.n", "k.idf")
    of = lambda field, c: F.when(F.col("field") == field, c)
    entries = {f: F.sort_array(F.collect_set(of(f, F.struct("id", "df")))).alias(f) for f in ("core", "addr", "num", "name")}
    rows = each.groupBy("country", "code").agg(F.max("n").alias("n"), *entries.values(), *(F.sum(of(f, F.col("idf"))).alias(f"{f}_total") for f in ("core", "addr")))
    idf = lambda e, n: B.idf(e["df"], n)
    square = lambda field, block: F.aggregate(F.filter(field, lambda e: e["df"] <= limits[block] * F.col("n")), F.lit(0.0), lambda x, e: x + idf(e, F.col("n")) * idf(e, F.col("n")))
    norms = [F.sqrt(sum((square(f, block) for f in fields), F.lit(0.0))).alias(block) for block, fields in (("fielded", ("core", "addr", "num")), ("addr_block", ("addr", "num")), ("name_word", ("name",))) for block in [block.removesuffix("_block")]]
    lists = [F.col(f)[part].alias(f"{f}_{part}") for f in ("core", "addr", "num", "name") for part in ("id", "df")]
    rows = rows.select("code", F.struct("n", *norms, *lists).alias("row"), "core_total", "addr_total")
    return rows.groupBy("code").agg(F.collect_list("row").alias("vec"), F.sum("core_total").alias("core_total"), F.sum("addr_total").alias("addr_total"))


def char_vectors(chars: DataFrame) -> DataFrame:
    """code, grams: ids of grams, the code points of up to three characters, and weights."""
    point = lambda i: F.ascii(F.substring("token", i, 1)).cast("long")
    gram = F.shiftleft(point(1), 42) + F.shiftleft(point(2), 21) + point(3)
    return chars.select("code", gram.alias("id"), "w").groupBy("code").agg(F.sort_array(F.collect_list(F.struct("id", "w"))).alias("g")).select("code", F.struct(F.col("g.id").alias("id"), F.col("g.w").alias("w")).alias("grams"))


def _dot(spark: SparkSession, a: str, b: str) -> Column:
    return jvm.function(spark, "Dot", DoubleType())(f"{a}.id", f"{a}.w", f"{b}.id", f"{b}.w")


def _common(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)).cast("double")


def build(cands: DataFrame, attrs: DataFrame, max_df: dict[str, float] | None = None) -> DataFrame:
    """s1, cand and the features of pairs (q, c, rank_<block>..., n_blocks)."""
    limits = {**B.BLOCK_MAX_DF, **(max_df or {})}
    attrs, cands = stored(_lean(attrs), "attributes"), stored(cands, "candidates")
    tok, sizes = stored(tokens_of(attrs.withColumn("addr_t", F.array_distinct(T.tokens(F.col("addr_norm"))))), "tokens"), B.country_sizes(attrs)
    stats = stored(B.field_statistics(tok, sizes), "statistics")
    generic = stored(_generic(attrs), "generic")  # whole records aren't shuffled for it

    chars = stored(char_vectors(char_weights(attrs, limits["name_char"])), "chars")
    vecs = stored(vectors(tok, stats, limits), "vectors")
    drop(tok)
    numbers = stored(vecs.select("code", "vec").join(chars, "code", "full").select("code", F.struct("vec", "grams").alias("side")), "numbers")
    t = attrs.drop("country", "sets").join(vecs.drop("vec"), "code", "left").na.fill(0.0, ["core_total", "addr_total"]).join(generic, ["code", "said"], "left").drop("said")
    t = stored(t.select("code", F.struct(*(x for x in t.columns if x != "code")).alias("side")), "sides")
    few = stored(attrs.select("code", "sets", "num_t").join(chars, "code", "left"), "few")
    for done in (attrs, vecs, chars):
        drop(done)
    sums = jvm.function(cands.sparkSession, "Sums", ArrayType(DoubleType()))("a.vec", "b.vec", *(F.lit(limits[x]) for x in ("fielded", "addr", "name_word")))
    rounds = max(1, -(-cands.count() // max(1, t.count())))
    parts = _rounds(cands, numbers, rounds, "left", "sums", lambda d: d.withColumn("sums", sums).withColumn("name_char_cos", _dot(d.sparkSession, "a.grams", "b.grams")).drop("a", "b"))
    drop(numbers)
    parts = _rounds(parts, t, rounds, "inner", "scored", _columns)
    out = stored(context(parts, CONTEXT, "s1"), "features")  # before it is joined with itself
    return _top_consistency(out, few)


def _rounds(pairs: DataFrame, sides: DataFrame, rounds: int, how: str, name: str, of) -> DataFrame:
    """of(pairs beside the sides a of q and b of c), stored. What a side holds travels beside pairs, so pairs are taken by c in rounds of about as many as there are records: disk grows with the records."""
    mine = stored(sides.join(pairs.select(F.col("q").alias("code")).distinct(), "code", "left_semi"), f"{name}-queries")
    tasks = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs.count() // (rounds * TASK)))  # by pairs, as their scores take more time than their bytes tell
    mine, parts = mine.select(F.col("code").alias("q"), F.col("side").alias("a")).repartition(tasks, "q"), []
    for i in range(rounds):
        here = lambda key, i=i: F.pmod(F.xxhash64(F.lit(3), key), F.lit(rounds)) == i
        df = pairs.where(here("c")).join(sides.where(here("code")).select(F.col("code").alias("c"), F.col("side").alias("b")), "c", how)
        parts.append(stored(of(df.repartition(tasks, "q").join(mine, "q", how)), f"{name}-{i}" if i else name))
    drop(mine)
    return reduce(DataFrame.unionByName, parts)


def _columns(df: DataFrame) -> DataFrame:
    """The features of pairs beside their sums and both sides."""
    df = df.withColumn("scores", scores(df.sparkSession, "a", "b"))

    a, b = (lambda n: F.col(f"a.{n}")), (lambda n: F.col(f"b.{n}"))
    score, summed = (lambda name: F.col("scores")[SCORES.index(name)]), (lambda name: F.col("sums")[SUMS.index(name)])
    n = lambda side, name: F.size(side(name)).cast("double")
    eq = lambda x, y: ((x == y) & (x != "")).cast("double")
    jacc = lambda i, x, y: T.safe_div(i, x + y - i)
    first = lambda side, name: F.coalesce(F.try_element_at(side(name), F.lit(1)), F.lit(""))
    postal = lambda side: F.filter(side("num_t"), lambda t: F.char_length(t).between(5, 6))
    ni, ci, ai, mi, pi, ki = _common(a("name_t"), b("name_t")), _common(a("core_t"), b("core_t")), score("addr_common"), _common(a("comp_t"), b("comp_t")), _common(postal(a), postal(b)), _common(a("num_t"), b("num_t"))
    na, nb, ca, cb, aa, ab = n(a, "name_t"), n(b, "name_t"), n(a, "core_t"), n(b, "core_t"), a("addr_n").cast("double"), b("addr_n").cast("double")
    ka, kb, pa, pb = n(a, "num_t"), n(b, "num_t"), F.size(postal(a)), F.size(postal(b))
    la, lb = F.char_length(a("name_norm")).cast("double"), F.char_length(b("name_norm")).cast("double")
    ini_a, ini_b = T.initials(a("core_all")), T.initials(b("core_all"))
    both = (ka > 0) & (kb > 0)
    rank = lambda block: F.when(F.col(f"rank_{block}") < 0, 99).otherwise(F.col(f"rank_{block}")).cast("double")
    columns = {
        "name_exact": (a("name_norm") == b("name_norm")).cast("double"), "core_exact": (a("name_core") == b("name_core")).cast("double"),
        "name_ratio": score("name_ratio") / 100, "core_ratio": score("core_ratio") / 100, "name_jw": score("name_jw"),
        "core_dl": score("core_dl"), "name_tsort": score("name_tsort") / 100, "name_tset": score("name_tset") / 100, "core_partial": score("core_partial") / 100,
        "name_common": ni, "name_jacc": jacc(ni, na, nb), "name_dice": T.safe_div(2 * ni, na + nb), "name_overlap": T.safe_div(ni, F.least(na, nb)), "core_common": ci, "core_jacc": jacc(ci, ca, cb),
        "core_idf_cov_a": T.safe_div(summed("core_sum"), a("core_total")), "core_idf_cov_b": T.safe_div(summed("core_sum"), b("core_total")), "core_idf_shared": summed("core_sum"), "core_max_shared_idf": summed("core_top"),
        "name_word_cos": summed("name_word_cos"), "name_char_cos": F.col("name_char_cos"), "name_len_ratio": T.safe_div(F.least(la, lb), F.greatest(la, lb)), "name_ntok_diff": F.abs(na - nb), "core_ntok_a": ca, "core_ntok_b": cb,
        "first_core_eq": eq(first(a, "core_all"), first(b, "core_all")), "acronym_match": F.greatest(eq(ini_a, b("name_core")), eq(ini_b, a("name_core"))), "name_generic_a": a("name_generic"), "name_generic_b": b("name_generic"),
        "b_name_nonascii": b("name_nonascii"), "b_name_domain": b("name_domain"), "b_name_alias": b("name_alias"),
        "addr_exact": eq(b("addr_norm"), a("addr_norm")), "addr_ratio": score("addr_ratio") / 100, "addr_tset": score("addr_tset") / 100, "addr_tsort": score("addr_tsort") / 100,
        "addr_common": ai, "addr_jacc": jacc(ai, aa, ab), "addr_idf_cov_a": T.safe_div(summed("addr_sum"), a("addr_total")), "addr_idf_cov_b": T.safe_div(summed("addr_sum"), b("addr_total")), "addr_cos": summed("addr_cos"), "fielded_cos": summed("fielded_cos"),
        "comp_common": mi, "comp_cov_a": T.safe_div(mi, n(a, "comp_t")), "comp_jacc": jacc(mi, n(a, "comp_t"), n(b, "comp_t")), "last_comp_eq": F.coalesce((F.try_element_at(a("comp_t"), F.lit(-1)) == F.try_element_at(b("comp_t"), F.lit(-1))).cast("double"), F.lit(0.0)),
        "addr_ntok_a": aa, "addr_ntok_b": ab, "b_addr_empty": (b("addr_norm") == "").cast("double"), "b_addr_nonascii": b("addr_nonascii"), "addr_generic_a": a("addr_generic"), "addr_generic_b": b("addr_generic"),
        "num_common": ki, "num_jacc": jacc(ki, ka, kb), "num_cov_a": T.safe_div(ki, ka), "num_idf_shared": summed("num_sum"), "num_conflict": (both & (ki == 0)).cast("double"), "num_cnt_a": ka, "num_cnt_b": kb, "num_cnt_diff": F.abs(ka - kb),
        "house_number_match": F.coalesce(F.array_contains(b("num_t"), F.try_element_at(a("nums_all"), F.lit(1))).cast("double"), F.lit(0.0)), "first_num_eq": eq(first(a, "nums_all"), first(b, "nums_all")),
        "pin_both": ((pa > 0) & (pb > 0)).cast("double"), "pin_exact_match": (pi > 0).cast("double"), "pin_conflict": ((pa > 0) & (pb > 0) & (pi == 0)).cast("double"),
        "b_is_s3": (b("source") == 3).cast("double"), "n_blocks": F.col("n_blocks").cast("double"), **{f"rank_{x}": rank(x) for x in B.BLOCK_K},
    }
    return df.select(F.col("q").alias("s1"), F.col("c").alias("cand"), *(v.alias(k) for k, v in columns.items()))


def _top_consistency(features: DataFrame, few: DataFrame) -> DataFrame:
    """Each candidate against the entity's best one by fielded_cos."""
    w = Window.partitionBy("s1").orderBy(F.round("fielded_cos", 9).desc(), "cand")
    df = features.withColumn("top", F.first("cand").over(w))
    side = lambda key, name: few.select(F.col("code").alias(key), F.struct("sets", "num_t", "grams").alias(name))
    df = df.join(side("cand", "x"), "cand").join(side("top", "y"), "top")
    df = df.withColumn("n", packed_common("x.sets", "y.sets")).withColumn("top_char_cos", _dot(df.sparkSession, "x.grams", "y.grams"))
    jacc = lambda f: T.safe_div(F.col(f"n.{f}"), F.col(f"n.{f}_either"))
    return df.withColumn("is_top", (F.col("cand") == F.col("top")).cast("double")).withColumn("top_name_jacc", jacc("first")).withColumn("top_addr_jacc", jacc("second")).withColumn("top_num_common", _common(F.col("x.num_t"), F.col("y.num_t"))).drop("x", "y", "n", "top")


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("s1", "cand", "y", "set", "country")]
