"""Choice of decision policies by F0.5 over a tuning set, holdouts, and the choice among unions of blocks."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import stored
from . import evaluate as E
from .policy import entity_stats

#: Grids of thresholds, of shares of the best score, and of the best score itself; how far other grids reach around the best threshold.
THRESHOLDS = [round(0.05 + 0.01 * k, 2) for k in range(95)]
ALPHAS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6]
TAUS = [round(0.3 + 0.03 * k, 2) for k in range(24) if 0.3 + 0.03 * k <= 0.991]
REACH, STEP = 0.2, 0.02
#: Lists for each query of the block unions that are compared.
UNIONS = [dict(zip(("fielded", "addr", "name_char", "name_word"), k, strict=True)) for k in ((10, 0, 0, 0), (20, 0, 0, 0), (30, 0, 0, 0), (10, 5, 5, 0), (15, 5, 5, 5), (20, 5, 5, 5), (20, 10, 10, 5), (30, 10, 10, 10), (30, 15, 15, 10))]


def _near(t: float) -> list[float]:
    low, high = max(0.05, t - REACH), min(0.99, t + REACH)
    return [round(low + STEP * k, 3) for k in range(int((high - low) / STEP + 1e-9) + 1)]


def measure_options(scored: DataFrame, sizes: DataFrame, options: list[dict]) -> DataFrame:
    """option (its place), f05: each entity's candidates, a list of at most the blocks' limits, meet a stated grid of options.

    scored: s1, p, p_rel, p_max, is_s3, is_true; sizes: s1, n_true. An option has t2 and t3, alpha and tau.
    """
    fields = ("t2", "t3", "alpha", "tau")
    rows = [(k, *(float(o.get(f, 0.0)) for f in fields)) for k, o in enumerate(options)]
    grid = F.array(*(F.struct(F.lit(r[0]).alias("k"), *(F.lit(v).alias(f) for f, v in zip(fields, r[1:], strict=True))) for r in rows))
    lists = scored.groupBy("s1").agg(F.collect_list(F.struct("p", "p_rel", "p_max", F.col("is_s3").cast("int").alias("is_s3"), F.col("is_true").cast("int").alias("hit"))).alias("cands"))
    full = sizes.join(lists, "s1", "left").withColumn("cands", F.coalesce("cands", F.array().cast("array<struct<p:double,p_rel:double,p_max:double,is_s3:int,hit:int>>")))
    each = full.select("n_true", "cands", F.explode(grid).alias("o"))
    taken = F.filter("cands", lambda c: (c["p"] >= F.when(c["is_s3"] > 0, F.col("o.t3")).otherwise(F.col("o.t2"))) & (c["p_rel"] >= F.col("o.alpha")) & (c["p_max"] >= F.col("o.tau")))
    counted = each.withColumn("taken", taken).select("n_true", "o.k", F.size("taken").alias("n_pred"), F.size(F.filter("taken", lambda c: c["hit"] > 0)).alias("tp"))
    return counted.groupBy(F.col("k").alias("option")).agg(F.avg(E.f05(F.col("tp"), F.col("n_pred"), F.col("n_true"))).alias("f05"))


def _best(scored: DataFrame, sizes: DataFrame, options: list[dict]) -> tuple[dict, float]:
    """The option with the best F0.5; of equal ones that with the largest values."""
    found = {r["option"]: round(r["f05"], 12) for r in measure_options(scored, sizes, options).collect()}  # a row for each option
    k = max(found, key=lambda i: (found[i], tuple(options[i].values())))
    return options[k], found[k]


def tune_policies(scored: DataFrame, truth: DataFrame, entities: DataFrame) -> dict[str, tuple[dict, float]]:
    """name: (policy, F0.5) of the four rules over p, each with its best parameters (scored: s1, cand, p, is_s3)."""
    cands, sizes = E.prepare(entity_stats(scored), truth, entities)
    cands, sizes = stored(cands.select("s1", "p", "p_rel", "p_max", "is_s3", "is_true"), "tuned"), stored(sizes, "sizes")
    same = lambda t: {"t2": t, "t3": t}
    one, f = _best(cands, sizes, [same(t) for t in THRESHOLDS])
    out = {"global": ({"type": "global", "t": one["t2"]}, f)}
    near = _near(one["t2"])
    two, f = _best(cands, sizes, [{"t2": a, "t3": b} for a, b in product(near, near)])
    out["source"] = ({"type": "source", **two}, f)
    rel, f = _best(cands, sizes, [{**same(t), "alpha": a} for t, a in product(near, ALPHAS)])
    out["relative"] = ({"type": "relative", "t": rel["t2"], "alpha": rel["alpha"]}, f)
    top, f = _best(cands, sizes, [{**rel, "tau": t} for t in TAUS])
    out["abstain"] = ({"type": "abstain", "t": rel["t2"], "alpha": rel["alpha"], "tau": top["tau"]}, f)
    return out


def tune_threshold(scored: DataFrame, truth: DataFrame, entities: DataFrame, score: str) -> tuple[float, float]:
    """The threshold of a score with the best F0.5, and that."""
    grid = scored.sparkSession.createDataFrame([(t,) for t in THRESHOLDS], "threshold double")
    row = E.best(E.grid_search(*E.prepare(scored, truth, entities), grid, score)).first()
    return row["threshold"], row["f05"]


def split(folds: DataFrame, fold: int = 0) -> tuple[DataFrame, DataFrame]:
    """Entities of the other folds, and of this one."""
    return folds.where(F.col("fold") != fold), folds.where(F.col("fold") == fold)


def country_holdout(entities: DataFrame, country: str) -> tuple[DataFrame, DataFrame]:
    """Entities of the other countries, and of this one."""
    return entities.where(F.col("country") != country), entities.where(F.col("country") == country)


def set_of(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs with the set of their entity (sets: s1, set); pairs of entities without one go."""
    return pairs.join(sets.select("s1", "set"), "s1")


def union_recall(cands: DataFrame, truth: DataFrame, unions: list[dict[str, int]] | None = None) -> DataFrame:
    """union (its place), recall, avg_candidates: ranked candidates cut to each union of blocks, in one pass over them (cands: q, c, rank_<block>)."""
    unions = unions or UNIONS
    inside = lambda u: F.greatest(F.lit(False), *((F.col(f"rank_{b}") >= 0) & (F.col(f"rank_{b}") < k) for b, k in u.items()))
    marked = cands.join(truth.select(F.col("s1").alias("q"), F.col("cand").alias("c"), F.lit(1).alias("hit")).distinct(), ["q", "c"], "left")
    sums = marked.agg(F.count_distinct("q").alias("queries"), *(F.count_if(inside(u)).alias(f"n{i}") for i, u in enumerate(unions)), *(F.count_if(inside(u) & F.col("hit").isNotNull()).alias(f"h{i}") for i, u in enumerate(unions)))
    total = truth.select("s1", "cand").distinct().agg(F.greatest(F.lit(1), F.count(F.lit(1))).alias("total"))
    rows = F.explode(F.array(*(F.struct(F.lit(i).alias("union"), F.lit(str(u)).alias("limits"), F.col(f"n{i}").alias("pairs"), F.col(f"h{i}").alias("hits")) for i, u in enumerate(unions)))).alias("r")
    return sums.crossJoin(total).select("queries", "total", rows).select("r.union", "r.limits", "r.pairs", (F.col("r.hits") / F.col("total")).alias("recall"), (F.col("r.pairs") / F.greatest(F.lit(1), F.col("queries"))).alias("avg_candidates"))  # one row each


def choose_union(recalls: DataFrame, unions: list[dict[str, int]] | None = None, slack: float = 0.001, most: float = 50.0) -> dict[str, int]:
    """The fewest candidates among unions whose recall is within `slack` of the best and that have `most` on average at most."""
    rows = recalls.collect()  # a row for each union
    best = max(r["recall"] for r in rows)
    fit = [r for r in rows if r["recall"] >= best - slack and r["avg_candidates"] <= most] or rows
    return (unions or UNIONS)[min(fit, key=lambda r: (r["avg_candidates"], r["union"]))["union"]]
