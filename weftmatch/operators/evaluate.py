"""Entity-level evaluation: F0.5 of predicted match sets, candidate quality, threshold grids, calibration error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def f05(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """1 if both sets are empty, 0 without a hit, else 1.25 p r / (0.25 p + r)."""
    p, r = tp / n_pred, tp / n_true
    return F.when((n_true == 0) & (n_pred == 0), 1.0).when(tp == 0, 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def false_merges(tp: Column, n_pred: Column) -> Column:
    """Share of the entities with a prediction that have a wrong one; 0 if none predicts."""
    return F.coalesce(F.avg(F.when(n_pred > 0, (n_pred > tp).cast("int"))), F.lit(0.0))


def entity_table(pred: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """s1, n_pred, n_true, tp, precision, recall, f05 of every entity; repeated pairs count once, others' are left out."""
    ids = entities.select("s1").distinct()
    p, t = (x.select("s1", "cand").distinct().join(ids, "s1", "left_semi") for x in (pred, truth))
    sides = p.withColumn("p", F.lit(1)).join(t.withColumn("t", F.lit(1)), ["s1", "cand"], "full")
    counts = sides.groupBy("s1").agg(F.count("p").alias("n_pred"), F.count("t").alias("n_true"), F.sum(F.when(F.col("p").isNotNull() & F.col("t").isNotNull(), 1).otherwise(0)).alias("tp"))
    full = ids.join(counts, "s1", "left").na.fill(0, ["n_pred", "n_true", "tp"])
    tp, n_pred, n_true = F.col("tp"), F.col("n_pred"), F.col("n_true")
    share = lambda n: F.when(n > 0, tp / n).otherwise(0.0)
    return full.select("s1", "n_pred", "n_true", "tp", share(n_pred).alias("precision"), share(n_true).alias("recall"), f05(tp, n_pred, n_true).alias("f05"))


def summarize(table: DataFrame) -> DataFrame:
    """Twelve figures over all entities; those over no entity are null."""
    tp, n_pred, n_true = F.col("tp"), F.col("n_pred"), F.col("n_true")
    lone = n_true == 0
    return table.agg(
        F.count(F.lit(1)).alias("n_entities"), F.avg("f05").alias("f05"), F.avg(F.when(~lone, F.col("f05"))).alias("f05_nonsingleton"),
        (F.sum(tp) / F.greatest(F.lit(1), F.sum(n_pred))).alias("micro_precision"), (F.sum(tp) / F.greatest(F.lit(1), F.sum(n_true))).alias("micro_recall"),
        F.avg(F.when(n_pred > 0, F.col("precision"))).alias("macro_precision_predicted"), F.avg(F.when(~lone, F.col("recall"))).alias("macro_recall_nonsingleton"),
        F.avg(lone.cast("int")).alias("singleton_rate"), F.avg(F.when(lone, (n_pred == 0).cast("int"))).alias("singleton_accuracy"),
        false_merges(tp, n_pred).alias("false_merge_rate"), F.avg((n_pred == 0).cast("int")).alias("empty_prediction_rate"), F.avg(n_pred).alias("avg_predicted"),
    )


def by_group(table: DataFrame, groups: DataFrame) -> DataFrame:
    """group, f05: groups has (s1, group)."""
    return table.join(groups, "s1").groupBy("group").agg(F.round(F.avg("f05"), 5).alias("f05"))


def candidate_metrics(cands: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """Recall, coverage and size of candidate lists, and F0.5 if all true candidates, and no other, were chosen."""
    t = entity_table(cands, truth, entities)
    n, hit, true = F.col("n_pred"), F.col("tp"), F.col("n_true")
    oracle = F.when(true == 0, 1.0).when(hit == 0, 0.0).otherwise(1.25 * (hit / true) / (0.25 + hit / true))
    return t.agg(
        (F.sum(hit) / F.greatest(F.lit(1), F.sum(true))).alias("recall"), F.avg(F.when(true > 0, (hit == true).cast("int"))).alias("full_coverage"), F.avg(F.when(true > 0, (hit > 0).cast("int"))).alias("any_coverage"),
        F.avg(n).alias("avg_candidates"), F.percentile(n, F.lit(0.5)).alias("p50_candidates"), F.percentile(n, F.lit(0.95)).alias("p95_candidates"), F.max(n).alias("max_candidates"),
        F.avg((n == 0).cast("int")).alias("zero_rate"), F.sum(n).alias("pairs"), F.avg(oracle).alias("oracle_f05"),
    )


def prepare(scored: DataFrame, truth: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates of the entities with is_true, and entities with n_true of the whole truth."""
    ids = entities.select("s1").distinct()
    marked = truth.select("s1", "cand").distinct().withColumn("hit", F.lit(1))
    cands = scored.join(ids, "s1", "left_semi").join(marked, ["s1", "cand"], "left").withColumn("is_true", F.coalesce("hit", F.lit(0))).drop("hit")
    sizes = ids.join(marked.groupBy("s1").agg(F.count(F.lit(1)).alias("n_true")), "s1", "left").na.fill(0, ["n_true"])
    return cands, sizes


def grid_search(cands: DataFrame, sizes: DataFrame, thresholds: DataFrame, score: str = "score") -> DataFrame:
    """threshold and figures of accepting scores at or above it.

    Each candidate meets only the step of the grid that it reaches: counts of steps are summed from the highest one down
    inside the entity, and an entity without a change at a step adds what it had before. So rows do not multiply with the
    grid except for one row of each (entity, step), which the result needs anyway.
    """
    grid = thresholds.select("threshold").distinct()
    steps = sizes.crossJoin(F.broadcast(grid))  # a stated grid of thresholds against all entities
    steps = steps.select("s1", "n_true", "threshold")
    levels = F.broadcast(grid.agg(F.sort_array(F.collect_set("threshold")).alias("levels")))
    reached = cands.crossJoin(levels).withColumn("threshold", F.array_max(F.filter("levels", lambda t: t <= F.col(score)))).where("threshold is not null")
    counts = reached.groupBy("s1", "threshold").agg(F.count(F.lit(1)).alias("n"), F.sum("is_true").alias("hits"))
    down = Window.partitionBy("s1").orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, 0)
    full = steps.join(counts, ["s1", "threshold"], "left").withColumn("n_pred", F.coalesce(F.sum("n").over(down), F.lit(0))).withColumn("tp", F.coalesce(F.sum("hits").over(down), F.lit(0)))
    tp, n_pred, n_true = F.col("tp"), F.col("n_pred"), F.col("n_true")
    return full.groupBy("threshold").agg(
        F.avg(f05(tp, n_pred, n_true)).alias("f05"), (F.sum(tp) / F.greatest(F.lit(1), F.sum(n_pred))).alias("micro_precision"), (F.sum(tp) / F.greatest(F.lit(1), F.sum(n_true))).alias("micro_recall"),
        F.avg(F.when(n_true == 0, (n_pred == 0).cast("int"))).alias("singleton_accuracy"), false_merges(tp, n_pred).alias("false_merge_rate"), F.avg(n_pred).alias("avg_predicted"),
    )


def best(grid: DataFrame) -> DataFrame:
    """The row with the highest F0.5, the lowest threshold on a tie."""
    return grid.orderBy(F.round("f05", 12).desc(), "threshold").limit(1)


def ece(scored: DataFrame, p: str = "p", y: str = "y", bins: int = 20) -> DataFrame:
    b = scored.withColumn("bin", F.least(F.floor(F.col(p) * bins), F.lit(bins - 1))).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mp"), F.avg(y).alias("my"))
    return b.agg((F.sum(F.col("n") * F.abs(F.col("mp") - F.col("my"))) / F.sum("n")).alias("ece"))


def reliability(scored: DataFrame, p: str = "p", y: str = "y", bins: int = 10) -> DataFrame:
    """One row for each bin, empty ones too."""
    b = scored.withColumn("bin", F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_p"), F.avg(y).alias("frac_positive"))
    return scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(b, "bin", "left").na.fill(0, ["n"])
