"""Sinks: match and candidate lists, their reader and validator, an experiment log."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import decode_id, encode_id, list_size, source_of


def id_lists(pairs: DataFrame, score: str = "score") -> DataFrame:
    """s1, ids: comma-separated, best score first, distinct; ties by id."""
    one = pairs.groupBy("s1", "cand").agg(F.max(score).alias("score"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("k"), F.col("cand").alias("cand"))))
    return one.groupBy("s1").agg(ordered.alias("l")).select("s1", F.array_join(F.transform("l", lambda x: decode_id(x["cand"])), ",").alias("ids"))


def _guard(frame: DataFrame, problem: str) -> None:
    row = frame.limit(1).collect()
    if row:
        raise ValueError(f"{problem}: {row[0]}")


def check_lists(entities: DataFrame, cands: DataFrame, matches: DataFrame) -> None:
    """Entities are distinct, pairs are of known entities with records of sources 2 and 3, every match is a candidate."""
    _guard(entities.groupBy("s1").count().where("count > 1"), "entity more than once")
    for name, pairs in (("candidate", cands), ("match", matches)):
        _guard(pairs.where(~source_of(F.col("cand")).isin(2, 3)), f"{name} of another source")
        _guard(pairs.join(entities, "s1", "left_anti"), f"{name} of an unknown entity")
    _guard(matches.select("s1", "cand").distinct().join(cands.select("s1", "cand"), ["s1", "cand"], "left_anti"), "match is no candidate")


def submission_rows(entities: DataFrame, pairs: DataFrame, score: str = "score") -> DataFrame:
    """pos, line fields of every entity in the given order (entities: s1, pos)."""
    return entities.join(id_lists(pairs, score), "s1", "left").select("pos", decode_id(F.col("s1")).alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("ids"))


def write_submission(entities: DataFrame, cands: DataFrame, matches: DataFrame, folder: str, score: str = "score") -> dict[str, int]:
    """matching_results.tsv and candidate_pairs.tsv in a folder that driver and executors share, in entity order.

    Executors write sorted partitions; their bytes are then put after one another by the file system. No row comes to the driver's Python.
    """
    check_lists(entities.select("s1"), cands, matches)
    spark, stats = entities.sparkSession, {}
    for name, column, pairs in (("matching_results", "matched_entity_ids", matches), ("candidate_pairs", "candidate_entity_ids", cands)):
        parts = f"{folder}/{name}.parts"
        rows = submission_rows(entities, pairs, score)
        rows.orderBy("pos").select(F.concat_ws("\t", "source1_entity_id", "ids").alias("value")).write.mode("overwrite").text(parts)
        _concatenate(spark, parts, f"{folder}/{name}.tsv", f"source1_entity_id\t{column}\n")
        body = read_body(spark, f"{folder}/{name}.tsv")
        one = body.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("ids") == "").alias("empty"), F.coalesce(F.sum(list_size(F.col("ids"))), F.lit(0)).alias("pairs")).first()
        stats |= {f"{name}_{k}": one[k] for k in ("rows", "empty", "pairs")}
    return stats


def _concatenate(spark: SparkSession, parts: str, target: str, head: str) -> None:
    """The part files of a folder, in their order, after a head line; the folder goes."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(conf)
    out = fs.create(path(target), True)
    try:
        out.write(bytearray(head.encode()))
        for status in sorted(fs.listStatus(path(parts)), key=lambda x: x.getPath().getName()):
            if status.getPath().getName().startswith("part-"):
                part = fs.open(status.getPath())
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                part.close()
    finally:
        out.close()
    fs.delete(path(parts), True)


def read_body(spark: SparkSession, path: str) -> DataFrame:
    """entity, ids of a list file."""
    parts = F.split("value", "\t")
    return spark.read.text(path).where(~F.col("value").startswith("source1_entity_id\t")).select(parts[0].alias("entity"), F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("ids"))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """s1, cand of a list file; no rows keep the types."""
    lines = spark.read.text(path).where(~F.col("value").startswith("source1_entity_id\t"))
    parts = lines.select(F.split("value", "\t").alias("p")).where("size(p) = 2 and p[1] <> ''")
    return parts.select(encode_id(F.col("p")[0]).alias("s1"), F.explode(F.split(F.col("p")[1], ",")).alias("id")).select("s1", encode_id(F.col("id")).alias("cand"))


# ---- validation ----


def list_errors(lists: DataFrame, entities: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """rule, n, examples (five at most, sorted) over lists (entity, ids) against entities (entity), and known records (id) if given."""
    ids = F.filter(F.split("ids", ","), lambda x: x != "")
    rows = lists.select("entity", ids.alias("ids"))
    each = rows.select("entity", F.explode("ids").alias("id"))
    parts = {
        "duplicate_entity": rows.groupBy("entity").count().where("count > 1").select(F.col("entity").cast("string").alias("x")),
        "duplicate_id": rows.where(F.size("ids") != F.size(F.array_distinct("ids"))).select(F.col("entity").cast("string").alias("x")),
        "self_match": each.where(F.col("id").startswith("S1-")).select(F.col("id").alias("x")),
        "bad_prefix": each.where(~F.col("id").rlike("^S[123]-")).select(F.col("id").alias("x")),
        "missing_entity": entities.select("entity").distinct().join(rows, "entity", "left_anti").select(F.col("entity").cast("string").alias("x")),
        "extra_entity": rows.select("entity").distinct().join(entities, "entity", "left_anti").select(F.col("entity").cast("string").alias("x")),
    }
    if known is not None:
        parts["unknown_id"] = each.where(F.col("id").rlike("^S[23]-")).select("id").distinct().join(known.select("id"), "id", "left_anti").select(F.col("id").alias("x"))
    out = None
    for rule, frame in parts.items():
        ranked = frame.withColumn("rule", F.lit(rule))
        out = ranked if out is None else out.unionByName(ranked)
    counts = out.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    firsts = out.distinct().withColumn("r", F.row_number().over(_by_rule())).where("r <= 5").groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list("x")), ",").alias("examples"))
    return counts.join(firsts, "rule")


def _by_rule():
    from pyspark.sql import Window

    return Window.partitionBy("rule").orderBy("x")


def not_candidates(matching: DataFrame, candidates: DataFrame) -> DataFrame:
    """A warning, no error: entities with matches outside their candidates."""
    both = matching.select("entity", F.split("ids", ",").alias("m")).join(candidates.select("entity", F.split("ids", ",").alias("c")), "entity")
    return both.where(F.size(F.filter(F.array_except("m", "c"), lambda x: x != "")) > 0).select("entity")


def validate(spark: SparkSession, matching: str, candidates: str, entities: DataFrame, known: DataFrame | None = None) -> tuple[list[str], list[str]]:
    """Errors and warnings over the two files."""
    errors, frames = [], {}
    for path, column in ((matching, "matched_entity_ids"), (candidates, "candidate_entity_ids")):
        try:
            lines = spark.read.text(path)
            head = lines.first()
        except (AnalysisException, Py4JJavaError) as e:  # no such path, or the store refuses it
            errors.append(f"{path}: can't be read: {str(e).splitlines()[0]}")
            continue
        if head is None:
            errors.append(f"{path}: empty")
        elif head["value"].rstrip("\r") != f"source1_entity_id\t{column}":
            errors.append(f"{path}: header is {head['value']!r}" + ("; commas instead of tabs" if "," in head["value"] and "\t" not in head["value"] else ""))
        else:
            body = lines.where((F.trim("value") != "") & ~F.col("value").startswith("source1_entity_id\t"))
            if bad := body.where(~F.col("value").contains("\t")).count():
                errors.append(f"{path}: {bad} rows without a tab")
            parts = F.split(F.rtrim("value"), "\t")
            frames[column] = body.where(F.col("value").contains("\t")).select(parts[0].alias("entity"), F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("ids"))
            errors += [f"{path}: {r['rule']}: {r['n']} ({r['examples']})" for r in list_errors(frames[column], entities, known).orderBy("rule").collect()]
    warnings = []
    if len(frames) == 2 and (n := not_candidates(frames["matched_entity_ids"], frames["candidate_entity_ids"]).count()):
        warnings.append(f"{n} entities have matches outside their candidates")
    return errors, warnings


# ---- experiment log ----

LOG_COLUMNS = "id stage time variant rule threshold weight f05 micro_precision micro_recall singleton_accuracy false_merge_rate avg_predicted recall_at_k avg_candidates oracle_f05 runtime_s notes".split()


def log_experiment(spark: SparkSession, path: str, run: dict) -> None:
    """Adds one row of LOG_COLUMNS as JSON text; missing ones are null, others are refused."""
    if odd := set(run) - set(LOG_COLUMNS):
        raise ValueError(f"no columns of the log: {sorted(odd)}")
    row = {c: run.get(c) for c in LOG_COLUMNS}
    spark.createDataFrame([(json.dumps(row),)], "value string").coalesce(1).write.mode("append").text(path)


def read_log(spark: SparkSession, path: str, stage: str | None = None) -> DataFrame:
    """Rows of the log; older rows lack no column, a missing stage is the id's first part."""
    rows = spark.read.text(path).select(*(F.get_json_object("value", f"$.{c}").alias(c) for c in LOG_COLUMNS))
    rows = rows.withColumn("stage", F.coalesce("stage", F.split("id", "_")[0]))
    return rows.where(F.col("stage").startswith(stage)) if stage else rows


def run_report(entities: DataFrame, cands: DataFrame, matches: DataFrame) -> DataFrame:
    """By country: entities (s1, country), candidates and matches of each, and how many have none, one, several."""
    n = lambda d, name: d.groupBy("s1").agg(F.count(F.lit(1)).alias(name))
    full = entities.join(n(cands, "n_cand"), "s1", "left").join(n(matches, "n_match"), "s1", "left").na.fill(0, ["n_cand", "n_match"])
    m: Column = F.col("n_match")
    return full.groupBy("country").agg(F.count(F.lit(1)).alias("entities"), F.round(F.avg("n_cand"), 6).alias("avg_candidates"), F.round(F.avg(m), 6).alias("avg_matches"), F.round(F.avg((m > 0).cast("int")), 6).alias("non_empty_rate"), F.count_if(m == 0).alias("zero"), F.count_if(m == 1).alias("one"), F.count_if(m > 1).alias("multi"), F.max(m).alias("max_matches"))
