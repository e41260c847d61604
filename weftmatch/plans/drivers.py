"""Whole runs over delimited record tables: profile, baseline, inference."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..operators import blocking as B
from ..operators import evaluate as E
from ..operators import mining as M
from ..operators import model as L
from ..operators import policy as P
from ..operators import profile as R
from ..operators import sampling as K
from ..operators import tuning as U
from ..sources import sinks, tables
from ..sources.store import stored
from . import matcher as G

WEIGHTS, THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7), [float(t) for t in range(50, 101)]
COSINES = [round(0.05 + 0.01 * k, 2) for k in range(95)]


def prenormalized(sources: DataFrame) -> DataFrame:
    """country, code, source, raw and pre-normalised texts, numbers of records (entity_id, business_name, business_address, country, source)."""
    name, addr = F.col("business_name"), F.col("business_address")
    return sources.select("country", T.encode_id(F.col("entity_id")).alias("code"), "source", name.alias("name_raw"), addr.alias("addr_raw"), T.prenormalize_names(name, T.to_ascii).alias("name_pre"), T.prenormalize_addresses(addr, T.to_ascii).alias("addr_pre"), T.joined(T.numbers(addr)).alias("nums"))


def learn_normalizer(records: DataFrame, truth: DataFrame, min_count: int = 25) -> dict[str, DataFrame]:
    """Token maps of names and addresses (country, token, canon) and weak name tokens (country, token), from true pairs (s1, cand) alone."""
    out = {}
    a, b = (records.select(F.col("code").alias(k), F.col("country").alias(f"{k}_country"), F.col("name_pre").alias(f"{k}_name"), F.col("addr_pre").alias(f"{k}_addr")) for k in ("s1", "cand"))
    both = stored(truth.join(a, "s1").join(b, "cand").withColumn("country", F.col("s1_country")), "positives")
    for field in ("name", "addr"):
        pairs = both.select("country", T.tokens(F.col(f"s1_{field}")).alias("a_toks"), T.tokens(F.col(f"cand_{field}")).alias("b_toks"))
        freq = records.where("source = 1").select("country", F.explode(T.tokens(F.col(f"{field}_pre"))).alias("token")).groupBy("country", "token").agg(F.count(F.lit(1)).alias("n"))
        out[field] = stored(M.mine_token_maps(pairs, freq, min_count=min_count), f"map_{field}")
    maps = _maps(out["name"])
    mapped = both.join(F.broadcast(maps), "country", "left").select("country", *(T.apply_map(T.tokens(F.col(f"{k}_name")), F.col("mapping")).alias(n) for k, n in (("s1", "a_toks"), ("cand", "b_toks"))))
    out["weak"] = stored(M.instability_tokens(mapped).select("country", "token"), "weak")
    return out


def _maps(pairs: DataFrame) -> DataFrame:
    """A row for each country; its map holds mined tokens, which are at most the accepted substitutions."""
    return pairs.groupBy("country").agg(F.map_from_entries(F.collect_list(F.struct("token", "canon"))).alias("mapping"))


def normalized(records: DataFrame, normalizer: dict[str, DataFrame]) -> DataFrame:
    """records with name_norm, addr_norm and name_core; countries without maps keep their tokens."""
    out = records
    for field in ("name", "addr"):
        out = out.join(F.broadcast(_maps(normalizer[field])), "country", "left").withColumn(f"{field}_norm", T.joined(T.apply_map(T.tokens(F.col(f"{field}_pre")), F.col("mapping")))).drop("mapping")
    suffixes = M.suffix_tokens(out.where("source = 1").select("country", T.tokens(F.col("name_norm")).alias("toks")))
    weak = M.weak_tokens(normalizer["weak"], suffixes).groupBy("country").agg(F.collect_set("token").alias("weak"))  # tokens of a stated share of names
    out = out.join(F.broadcast(weak), "country", "left").withColumn("weak", F.coalesce("weak", F.array().cast("array<string>")))
    return out.withColumn("name_core", T.joined(T.core_tokens(T.tokens(F.col("name_norm")), F.col("weak")))).drop("weak")


def save_normalizer(normalizer: dict[str, DataFrame], path: str) -> None:
    for name, df in normalizer.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load_normalizer(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in ("name", "addr", "weak")}


def candidates(records: DataFrame, k: int = 50, max_df: float = 0.02, raw: bool = False) -> DataFrame:
    """s1, cand, score, rank: raw takes untransliterated tokens."""
    name, addr = (T.raw_tokens(F.col(f"{f}_raw")) if raw else F.col(f"{f}_norm") for f in ("name", "addr"))
    tok = B.field_tokens(records, {"n": T.tokens(name), "a": T.tokens(addr)})
    top = B.topk(B.tfidf_weights(tok, B.country_sizes(records), max_df), k)
    return top.select(F.col("q").alias("s1"), F.col("c").alias("cand"), F.round("score", 9).alias("score"), "rank")


def fuzzy_scores(cands: DataFrame, records: DataFrame) -> DataFrame:
    """name_sim, and addr_sim where both addresses have text."""
    a, b = (records.select(F.col("code").alias(k), F.struct("name_norm", "addr_norm").alias(n)) for k, n in (("s1", "x"), ("cand", "y")))
    some = (F.col("x.addr_norm") != "") & (F.col("y.addr_norm") != "")
    return cands.join(a, "s1").join(b, "cand").withColumn("name_sim", S.token_set_col("x.name_norm", "y.name_norm")).withColumn("addr_sim", F.when(some, S.token_set_col(F.when(some, F.col("x.addr_norm")), F.when(some, F.col("y.addr_norm"))))).drop("x", "y")


def tune_rules(cands: DataFrame, truth: DataFrame, entities: DataFrame) -> tuple[dict, float]:
    """The rule with the best F0.5 over the given entities: cosine threshold, or weight and threshold of fuzzy scores."""
    spark = cands.sparkSession
    marked, sizes = E.prepare(cands, truth, entities)
    marked, sizes = stored(marked, "marked"), stored(sizes, "sizes")
    grid = lambda ts: spark.createDataFrame([(t,) for t in ts], "threshold double")
    row = E.best(E.grid_search(marked, sizes, grid(COSINES))).first()
    best, rule = row["f05"], {"type": "tfidf", "t": row["threshold"]}
    for w in WEIGHTS:
        scored = marked.withColumn("score", F.round(P.combined(F.col("name_sim"), F.col("addr_sim"), w), 9))
        row = E.best(E.grid_search(scored, sizes, grid(THRESHOLDS))).first()
        if row["f05"] > best:
            best, rule = row["f05"], {"type": "fuzzy", "w": w, "t": row["threshold"]}
    return rule, best


def apply_rule(cands: DataFrame, rule: dict) -> DataFrame:
    if rule["type"] == "fuzzy":
        cands = cands.withColumn("combined", F.round(P.combined(F.col("name_sim"), F.col("addr_sim"), rule["w"]), 9))
    return P.apply_rule(cands, rule)


def run_baseline(sources: DataFrame, truth: DataFrame, k: int = 50, max_df: float = 0.02, min_count: int = 25, tune_share: float = 0.5) -> dict:
    """Learns the normaliser and tunes on one part of the entities, measures on the other: rule, tuning and evaluation figures."""
    records = stored(prenormalized(sources), "prenormalized")
    ents = records.where("source = 1").select(F.col("code").alias("s1"), "country")
    parts = stored(K.disjoint(ents, ["country"], "s1", {"tune": tune_share, "eval": 1.0}), "parts")
    tune, evaluation = (parts.where(F.col("set") == n).select("s1", "country") for n in ("tune", "eval"))
    rec = stored(normalized(records, learn_normalizer(records, truth.join(tune, "s1", "left_semi"), min_count)), "normalized")
    scored = stored(fuzzy_scores(candidates(rec, k, max_df), rec), "scored")
    rule, tuned = tune_rules(scored, truth, tune)
    pred = apply_rule(scored, rule)
    return {"rule": rule, "tuned_f05": tuned, "evaluation": E.summarize(E.entity_table(pred, truth, evaluation)).first().asDict(), "candidates": E.candidate_metrics(scored, truth, evaluation).first().asDict()}


def run_inference(sources: DataFrame, normalizer: dict[str, DataFrame], rule: dict, folder: str, k: int = 50, max_df: float = 0.02) -> dict:
    """Writes both list files for all entities of source 1 and validates them."""
    spark = sources.sparkSession
    rec = stored(normalized(prenormalized(sources), normalizer), "normalized")
    scored = stored(fuzzy_scores(candidates(rec, k, max_df), rec), "scored")
    matches = apply_rule(scored, rule)
    ents = rec.where("source = 1").select(F.col("code").alias("s1"), F.col("code").alias("pos"))
    stats = sinks.write_submission(ents, scored, matches, folder)
    names = ents.select(T.decode_id(F.col("s1")).alias("entity"))
    errors, warnings = sinks.validate(spark, f"{folder}/matching_results.tsv", f"{folder}/candidate_pairs.tsv", names)
    return {**stats, "errors": errors, "warnings": warnings, "report": [r.asDict() for r in sinks.run_report(rec.where("source = 1").select(F.col("code").alias("s1"), "country"), scored, matches).orderBy("country").collect()]}


def run_training(sources: DataFrame, truth: DataFrame, folder: str, min_count: int = 25, fractions: dict[str, float] | None = None, max_df: dict[str, float] | None = None, **params) -> dict:
    """Normaliser, features, model, calibrator and policy from labelled records; all are written to the folder. Fold 0 is kept out and measured."""
    records = stored(prenormalized(sources), "prenormalized")
    folds = stored(K.folds(records.where("source = 1").select(F.col("code").alias("s1"), "country"), ["country"], "s1"), "folds")
    dev, kept_out = U.split(folds)
    normalizer = learn_normalizer(records, truth.join(dev, "s1", "left_semi"), min_count)
    rec = stored(normalized(records, normalizer), "normalized")
    sets = stored(K.disjoint(dev.select("s1", "country"), ["country"], "s1", fractions or {"model": 0.5, "calib": 0.5, "val": 1.0}), "sets")
    feats, limits = G.dev_features(rec, truth, sets, weak=normalizer["weak"], max_df=max_df)
    spec, model, calibrator = G.train_and_select(feats, truth, sets, **params)
    spec |= {"limits": limits, "max_df": max_df}
    L.save(model, spec, folder, calibrator)
    save_normalizer(normalizer, f"{folder}/normalizer")
    return {**spec, "full": G.evaluate_full(rec, truth, kept_out.select("s1", "country"), model, calibrator, spec, limits, weak=normalizer["weak"], max_df=max_df)}


def run_learned_inference(sources: DataFrame, folder: str, out: str) -> dict:
    """Lists of all entities of source 1 by what run_training has written."""
    spark = sources.sparkSession
    model, spec, calibrator = L.load(folder)
    normalizer = load_normalizer(spark, f"{folder}/normalizer")
    rec = stored(normalized(prenormalized(sources), normalizer), "normalized")
    return G.run_inference(spark, rec, model, calibrator, spec, spec["limits"], out, weak=normalizer["weak"], max_df=spec["max_df"])


def profile_truth(truth: DataFrame, records: DataFrame) -> dict[str, DataFrame]:
    """Integrity, cardinalities, source mix and pair space of labels (s1, cand) over records (country, code, source)."""
    s1, others = records.where("source = 1").select(F.col("code").alias("s1")), records.where("source <> 1").select(F.col("code").alias("cand"))
    cards = s1.join(truth.groupBy("s1").agg(F.count_if(T.source_of(F.col("cand")) == 2).alias("n2"), F.count_if(T.source_of(F.col("cand")) == 3).alias("n3")), "s1", "left").na.fill(0, ["n2", "n3"])
    size = F.least(F.col("n2") + F.col("n3"), F.lit(30))
    return {
        "integrity": R.truth_integrity(truth, s1, others),
        "cardinalities": R.shares(cards.groupBy(size.alias("matches")).agg(F.count(F.lit(1)).alias("n"))),
        "source_mix": R.source_mix(cards),
        "pair_space": R.pair_space(records, truth),
    }


def pair_agreement(truth: DataFrame, records: DataFrame, n: int = 100_000, seed: int = 0) -> DataFrame:
    """kind (true or random), pairs, and how often and how far both sides agree: n sampled true pairs against as many random ones of the same countries."""
    side = lambda key, name: records.select(F.col("code").alias(key), F.struct("name_norm", "addr_norm", T.numbers(F.col("addr_raw")).alias("nums"), T.postal_tokens(F.col("addr_raw")).alias("postal")).alias(name))
    countries = records.where("source = 1").select(F.col("code").alias("s1"), "country")
    picked = stored(K.uniform_sample(truth.withColumn("at", F.col("s1") + F.col("cand")), "at", n, seed).drop("at").join(countries, "s1"), "picked")
    random = K.random_negatives(picked, records.where("source <> 1"), seed)
    pairs = picked.select("s1", "cand", F.lit("true").alias("kind")).unionByName(random.select("s1", "cand", F.lit("random").alias("kind")))
    both = pairs.join(side("s1", "a"), "s1").join(side("cand", "b"), "cand")
    jacc = lambda x, y: (lambda i: T.safe_div(i, F.size(x) + F.size(y) - i))(F.size(F.array_intersect(x, y)))
    words = lambda side, field: F.array_distinct(T.tokens(F.col(f"{side}.{field}_norm")))
    share = lambda c: F.round(F.avg(c.cast("int")), 6)
    some = (F.col("a.addr_norm") != "") & (F.col("b.addr_norm") != "")
    return both.groupBy("kind").agg(
        F.count(F.lit(1)).alias("pairs"), share(F.col("a.name_norm") == F.col("b.name_norm")).alias("name_equal"), share(some & (F.col("a.addr_norm") == F.col("b.addr_norm"))).alias("addr_equal"),
        F.round(F.avg(jacc(words("a", "name"), words("b", "name"))), 6).alias("name_jaccard"), F.round(F.avg(jacc(words("a", "addr"), words("b", "addr"))), 6).alias("addr_jaccard"),
        F.round(F.avg(S.token_set_col("a.name_norm", "b.name_norm")), 4).alias("name_token_set"), F.round(F.median(S.jaro_winkler_col("a.name_norm", "b.name_norm")), 6).alias("name_jaro_winkler_median"),
        share(F.arrays_overlap("a.nums", "b.nums")).alias("number_shared"), share(F.arrays_overlap("a.postal", "b.postal")).alias("postal_shared"), share(~some).alias("address_missing"),
    )


def profile(sources: DataFrame) -> dict[str, DataFrame]:
    """Tables about one or more sources."""
    name, addr = F.col("business_name"), F.col("business_address")
    norm = sources.select("country", T.basic_normalize(name, T.to_ascii).alias("n"), T.basic_normalize(addr, T.to_ascii).alias("a"))
    return {
        "integrity": R.integrity(sources, "entity_id", "S"),
        "name_patterns": R.group_rates(sources, "country", {k: T.flag(name, p) for k, p in T.NAME_PATTERNS.items()}),
        "address_patterns": R.group_rates(sources, "country", {k: T.flag(addr, p) for k, p in T.ADDR_PATTERNS.items()}),
        "name_lengths": R.quantiles(sources, F.char_length(name), "country"),
        "address_lengths": R.quantiles(sources, F.char_length(addr), "country"),
        "duplicate_names": R.duplicate_counts(sources, ["business_name"]),
        "duplicate_records": R.duplicate_counts(sources, ["business_name", "business_address", "country"]),
        "top_tokens": R.top_n(R.token_counts(norm, T.tokens(F.col("n")), "country"), 30, "country"),
        "top_names": R.top_n(sources.groupBy(name.alias("token")).agg(F.count(F.lit(1)).alias("n")), 12),
        "scripts": R.script_counts(sources, "business_name"),
    }


def render(tables_: dict[str, DataFrame], rows: int = 40) -> str:
    """Markdown; the first rows of each table, which are a report."""
    out = []
    for title, df in tables_.items():
        out += [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
        out += ["| " + " | ".join(str(v).replace("|", "\\|") for v in r) + " |" for r in df.limit(rows).collect()] + [""]
    return "\n".join(out)


def main(argv: list[str] | None = None) -> None:
    """profile ROOT SPLIT | baseline ROOT | learn ROOT NORMALIZER | infer ROOT SPLIT NORMALIZER RULE_JSON OUT | train ROOT MODEL | match ROOT SPLIT MODEL OUT | validate ROOT SPLIT OUT"""
    import sys

    from ..session import session

    args = sys.argv[1:] if argv is None else argv
    spark = session()
    if args[:1] == ["profile"] and len(args) == 3:
        print(render(profile(tables.load_all_sources(spark, args[1], args[2]))))
    elif args[:1] == ["baseline"] and len(args) == 2:
        truth = tables.truth_pairs(tables.load_ground_truth(spark, args[1]))
        print(json.dumps(run_baseline(tables.load_all_sources(spark, args[1], "train"), truth), default=str))
    elif args[:1] == ["learn"] and len(args) == 3:
        truth = tables.truth_pairs(tables.load_ground_truth(spark, args[1]))
        save_normalizer(learn_normalizer(prenormalized(tables.load_all_sources(spark, args[1], "train")), truth), args[2])
    elif args[:1] == ["infer"] and len(args) == 6:
        print(json.dumps(run_inference(tables.load_all_sources(spark, args[1], args[2]), load_normalizer(spark, args[3]), json.loads(args[4]), args[5]), default=str))
    elif args[:1] == ["train"] and len(args) == 3:
        truth = tables.truth_pairs(tables.load_ground_truth(spark, args[1]))
        print(json.dumps(run_training(tables.load_all_sources(spark, args[1], "train"), truth, args[2]), default=str))
    elif args[:1] == ["match"] and len(args) == 5:
        print(json.dumps(run_learned_inference(tables.load_all_sources(spark, args[1], args[2]), args[3], args[4]), default=str))
    elif args[:1] == ["validate"] and len(args) == 4:
        every = tables.load_all_sources(spark, args[1], args[2])
        names = every.where("source = 1").select(F.col("entity_id").alias("entity"))
        errors, warnings = sinks.validate(spark, f"{args[3]}/matching_results.tsv", f"{args[3]}/candidate_pairs.tsv", names, every.where("source <> 1").select(F.col("entity_id").alias("id")))
        print("\n".join([*errors, *warnings]) or "valid")
    else:
        raise SystemExit(main.__doc__)
