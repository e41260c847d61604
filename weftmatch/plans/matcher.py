"""The learned matcher: candidates of all blocks, pair features, training and choice of a policy, scoring, evaluation.

Records are normalised (country, code, source, name_raw, addr_raw, name_norm, addr_norm). Tokens and statistics of the
blocks are made once and shared by them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import blocking as B
from ..operators import evaluate as E
from ..operators import features as X
from ..operators import model as L
from ..operators import tuning as U
from ..sources import sinks
from ..sources.store import stored

#: Features that the second stage sees beside the entity's statistics.
STAGE2_COLUMNS = ["fielded_cos", "name_tset", "name_char_cos", "addr_tset", "core_idf_cov_a", "house_number_match", "num_conflict", "b_is_s3", "b_addr_empty", "n_cands", "n_blocks", "name_generic_a"]


def candidates(rec: DataFrame, weak: DataFrame | None = None, max_df: dict[str, float] | None = None) -> DataFrame:
    """q, c, rank_<block>, n_blocks: the union of all blocks."""
    rec, limits = stored(rec, "records"), {**B.BLOCK_MAX_DF, **(max_df or {})}
    tok = stored(B.field_tokens(rec, {"name": T.tokens(F.col("name_norm")), "addr": T.tokens(F.col("addr_norm")), "num": T.numbers(F.col("addr_raw"))}), "tokens")
    stats = stored(B.field_statistics(tok, B.country_sizes(rec)), "statistics")
    blocks = {b: B.topk(B.block_weights(tok, stats, fields, limits[b], weak if b == "fielded" else None), B.BLOCK_K[b]) for b, fields in B.BLOCK_FIELDS.items()}
    blocks["name_char"] = B.topk(X.char_weights(rec, limits["name_char"]), B.BLOCK_K["name_char"])
    return stored(B.generate_candidates({b: blocks[b] for b in B.BLOCK_K}), "candidates")


def dev_features(rec: DataFrame, truth: DataFrame, sets: DataFrame, limits: dict[str, int] | None = None, weak: DataFrame | None = None, max_df: dict[str, float] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Features of the candidates of entities in sets (s1, set), with y and set; and the block union that they were cut to: the chosen one if none is given."""
    cands = candidates(rec, weak, max_df).join(sets.select(F.col("s1").alias("q")), "q", "left_semi")
    limits = limits or U.choose_union(U.union_recall(cands, truth.join(sets, "s1", "left_semi")))
    feats = X.build(B.restrict(cands, {**dict.fromkeys(B.BLOCK_K, 0), **limits}), X.attributes(rec, weak), max_df)  # what depends on the list is made after the cut
    marked = feats.join(truth.select("s1", "cand", F.lit(1.0).alias("y")).distinct(), ["s1", "cand"], "left").na.fill(0.0, ["y"])
    return stored(U.set_of(marked, sets), "features"), limits


def train_and_select(feats: DataFrame, truth: DataFrame, sets: DataFrame, kinds: tuple[str, ...] = ("gbt", "forest"), **params) -> tuple[dict, object, object]:
    """Trains on set model, calibrates and chooses on set calib, measures on set val; the specification, the model and its calibrator.

    The kind of model is the one with the best threshold; policies, and the second stage, compete for the best F0.5.
    """
    columns = X.feature_columns(feats)
    part = {name: feats.where(F.col("set") == name) for name in ("model", "calib", "val")}
    ents = {name: sets.where(F.col("set") == name).select("s1") for name in part}
    checked = part["model"].withColumn("check", F.pmod(F.xxhash64("s1"), F.lit(5)) == 0)  # whole entities
    tried = {}
    for kind in kinds:
        model = L.train(checked, columns, kind=kind, validation="check" if kind == "gbt" else None, **(params if kind == "gbt" else {}))
        tried[kind] = (U.tune_threshold(L.predict(model, part["calib"]), truth, ents["calib"], "p")[1], model)
    kind = max(tried, key=lambda k: tried[k][0])
    model = tried[kind][1]
    raw = stored(L.predict(model, part["calib"], "raw"), "raw")
    calibrator = L.isotonic_model(raw, "raw", "y")
    scored = stored(L.calibrated(calibrator, raw, "raw").withColumn("is_s3", F.col("b_is_s3")), "scored")
    policies = U.tune_policies(scored.select("s1", "cand", "p", "is_s3"), truth, ents["calib"])
    second = stored(L.stage2(scored, STAGE2_COLUMNS), "second")
    t, f = U.tune_threshold(second, truth, ents["calib"], "p2")
    policies["stage2"] = ({"type": "stage2", "t": t}, f)
    rules = {n: x for n, x in policies.items() if n != "stage2"}  # the second stage has no model of its own to keep: it is compared only
    name = max(rules, key=lambda n: rules[n][1])
    spec = {"kind": kind, "columns": columns, "policy": rules[name][0], "tuned": {n: {"policy": x[0], "f05": x[1]} for n, x in policies.items()}, "kinds": {k: x[0] for k, x in tried.items()}}
    stats, accepted = L.score_candidates(model, calibrator, part["val"], spec["policy"])
    spec["validation"] = E.summarize(E.entity_table(accepted, truth, ents["val"])).first().asDict()
    spec["calibration_error"] = E.ece(stats, "p", "y").first()["ece"]
    spec["importance"] = L.importance(model, columns) if kind != "linear" else {}
    return spec, model, calibrator


def feature_groups(columns: list[str]) -> dict[str, list[str]]:
    """Columns by what they look at, in the order in which an ablation adds them."""
    rest, out = list(columns), {}
    rules = {
        "name_string": lambda c: c.startswith(("name_", "core_", "first_core", "acronym", "b_name")) and "idf" not in c and "cos" not in c and "generic" not in c and not c.endswith(("_gap", "_rank")),
        "address": lambda c: c.startswith(("addr_", "comp_", "last_comp", "b_addr")) and "idf" not in c and "cos" not in c and "generic" not in c and not c.endswith(("_gap", "_rank")),
        "numeric": lambda c: c.startswith(("num_", "house", "first_num", "pin_")) and "idf" not in c,
        "rare_token_idf": lambda c: ("idf" in c or "cos" in c or "generic" in c) and not c.endswith(("_gap", "_rank")),
        "block_agreement": lambda c: c.startswith("rank_") or c in ("n_blocks", "b_is_s3"),
    }
    for name, rule in rules.items():
        out[name] = [c for c in rest if rule(c)]
        rest = [c for c in rest if not rule(c)]
    return {**out, "rest": rest}


def ablation(feats: DataFrame, truth: DataFrame, sets: DataFrame, **params) -> list[dict]:
    """F0.5 on set val for each growing list of feature groups, with the best threshold on set calib."""
    part = {name: feats.where(F.col("set") == name) for name in ("model", "calib", "val")}
    ents = {name: sets.where(F.col("set") == name).select("s1") for name in part}
    used: list[str] = []
    out = []
    for name, columns in feature_groups(X.feature_columns(feats)).items():
        used = used + columns
        if not used:
            continue
        model = L.train(part["model"], used, **params)
        t, _ = U.tune_threshold(L.predict(model, part["calib"]), truth, ents["calib"], "p")
        taken = L.predict(model, part["val"]).where(F.col("p") >= t)
        out.append({"group": name, "n_features": len(used), "f05": E.summarize(E.entity_table(taken, truth, ents["val"])).first()["f05"]})
    return out


def score(rec: DataFrame, model, calibrator, spec: dict, limits: dict[str, int], weak: DataFrame | None = None, max_df: dict[str, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """Scored candidates of all entities, and the accepted ones."""
    cands = B.restrict(candidates(rec, weak, max_df), {**dict.fromkeys(B.BLOCK_K, 0), **limits})
    scored, accepted = L.score_candidates(model, calibrator, X.build(cands, X.attributes(rec, weak), max_df), spec["policy"])
    scored = stored(scored, "scored")
    return scored, scored.join(accepted.select("s1", "cand"), ["s1", "cand"], "left_semi")


def evaluate_full(rec: DataFrame, truth: DataFrame, entities: DataFrame, model, calibrator, spec: dict, limits: dict[str, int], **how) -> dict:
    """The path of inference over all records, measured on given entities (s1, country): all figures, by country, and of the candidates."""
    scored, accepted = score(rec, model, calibrator, spec, limits, **how)
    table = stored(E.entity_table(accepted, truth, entities), "table")
    return {
        "summary": E.summarize(table).first().asDict(),
        "by_country": {r["group"]: r["f05"] for r in E.by_group(table, entities.select("s1", F.col("country").alias("group"))).collect()},  # a row for each country
        "candidates": E.candidate_metrics(scored, truth, entities).first().asDict(),
    }


def run_inference(spark: SparkSession, rec: DataFrame, model, calibrator, spec: dict, limits: dict[str, int], folder: str, **how) -> dict:
    """Writes both list files for all entities of source 1 and validates them."""
    scored, accepted = score(rec, model, calibrator, spec, limits, **how)
    ents = rec.where("source = 1").select(F.col("code").alias("s1"), F.col("code").alias("pos"))
    stats = sinks.write_submission(ents, scored, accepted, folder, "p")
    names = ents.select(T.decode_id(F.col("s1")).alias("entity"))
    errors, warnings = sinks.validate(spark, f"{folder}/matching_results.tsv", f"{folder}/candidate_pairs.tsv", names)
    return {**stats, "errors": errors, "warnings": warnings}

