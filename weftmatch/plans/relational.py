"""Queries of scans, scalar functions, joins, set operations, aggregates and profiles over the driver's tables; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import profile as R
from .records import REC, TRUTH, q, records, sql_clean, sql_fold, sql_norm, sql_tokens, table, truth

Q: dict[str, object] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        Q[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def r6(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


# ---- scans and identifiers ----


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 1000")
def scan_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' AND o_totalprice > 1000").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT DISTINCT lang AS country FROM documents")
def partition_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("lang").alias("country")).distinct()


@query("SELECT s_suppkey, CAST(1 + s_suppkey % 3 AS BIGINT) * 10000000000 + s_suppkey AS code FROM supplier")
def encode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("S"), (1 + F.col("s_suppkey") % 3).cast("string"), F.lit("-"), F.col("s_suppkey").cast("string"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", T.encode_id(text).alias("code"))


@query("SELECT doc_id, 'S' || CAST(1 + doc_id % 3 AS VARCHAR) || '-' || CAST(doc_id AS VARCHAR) AS entity_id, CAST(1 + doc_id % 3 AS INTEGER) AS source FROM documents")
def decode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = (1 + F.col("doc_id") % 3) * T.ID_BASE + F.col("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", T.decode_id(code).alias("entity_id"), T.source_of(code).alias("source"))


# ---- scalar functions ----


def _per_doc(name: str, sql: str, column):
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, "documents").select("doc_id", column(F.coalesce("text", F.lit(""))).alias("value"))

    fn.__name__ = name
    return query(f"SELECT doc_id, {sql} AS value FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)")(fn)


_NOAP = "translate(text, '''’', '')"
_OCR = "list_transform({0}, lambda t: CASE WHEN regexp_matches(t, '^[a-z]+$') OR regexp_matches(t, '^[0-9]+$') OR regexp_matches(t, '^[0-9]+(st|nd|rd|th)$') OR length(regexp_replace(t, '[^a-z]', '', 'g')) < 2 OR regexp_matches(t, '[279]') THEN t ELSE translate(t, '0134568', 'oleasgb') END)"
_ADDR = r"array_to_string(list_transform(list_filter({0}, lambda t: t <> 'null'), lambda t: CASE WHEN regexp_matches(t, '^[0-9]+$') THEN regexp_replace(t, '^0+([0-9])', '\1') ELSE t END), ' ')"
_NUMS = r"list_transform(regexp_extract_all({0}, '[0-9]+'), lambda t: regexp_replace(t, '^0+([0-9])', '\1'))"

_per_doc("normalize_text", sql_norm("text"), T.basic_normalize)
_per_doc("normalize_ascii", sql_norm("text"), lambda c: T.basic_normalize(c, T.to_ascii))
_per_doc("raw_tokens", sql_clean("text"), T.raw_tokens)
_per_doc("ocr_repair", f"array_to_string({_OCR.format(sql_tokens(sql_clean('text')))}, ' ')", lambda c: T.joined(F.transform(T.tokens(T.raw_tokens(c)), T.fix_ocr_token)))
_per_doc("prenormalize_addresses", _ADDR.format(sql_tokens(sql_norm(_NOAP))), T.prenormalize_addresses)
_per_doc("address_numbers", f"array_to_string({_NUMS.format('text')}, ' ')", lambda c: T.joined(T.numbers(c)))
_per_doc("first_number", f"{_NUMS.format('text')}[1]", T.first_number)
_per_doc("initials", f"CASE WHEN len({sql_tokens(sql_norm('text'))}) >= 2 THEN array_to_string(list_transform({sql_tokens(sql_norm('text'))}, lambda t: t[1:1]), '') ELSE '' END", lambda c: T.initials(T.tokens(T.basic_normalize(c))))
_per_doc("case_classes", "CASE WHEN regexp_matches(text, '[A-Za-z]') AND text = upper(text) THEN 'all_upper' WHEN regexp_matches(text, '[A-Za-z]') AND text = lower(text) THEN 'all_lower' ELSE 'mixed' END", T.case_class)
_COMP = f"list_filter(list_transform(string_split(lower({sql_fold(_NOAP)}), ','), lambda p: {_ADDR.format(sql_tokens(sql_clean('p')))}), lambda p: p <> '')"
_per_doc("components", f"array_to_string({_COMP}, '|')", lambda c: F.array_join(T.components(c), "|"))


@query()
def prenormalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.prenormalize_names(F.coalesce("text", F.lit(""))).alias("value"))


@query(f"WITH {REC} SELECT code, array_to_string(CASE WHEN len(k) = 0 THEN t ELSE k END, ' ') AS name_core FROM (SELECT code, {sql_tokens('name_norm')} AS t, list_filter({sql_tokens('name_norm')}, lambda t: t NOT IN ('the', 'and', 'of', 'is', 'la', 'der')) AS k FROM rec)")
def core_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    weak = F.array(*map(F.lit, ("is", "la", "der")))
    return records(spark, sf_dir).select("code", T.joined(T.core_tokens(T.tokens(F.col("name_norm")), weak)).alias("name_core"))


_MAP = {"the": "teh", "and": "und", "la": "el"}


@query(f"WITH {REC} SELECT code, array_to_string(list_transform({sql_tokens('name_norm')}, lambda t: CASE WHEN country <> 'en' THEN t " + " ".join(f"WHEN t = '{a}' THEN '{b}'" for a, b in _MAP.items()) + " ELSE t END), ' ') AS mapped FROM rec")
def apply_token_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map for each country; countries without one keep their tokens."""
    maps = spark.createDataFrame([("en", _MAP)], "country string, mapping map<string,string>")
    rec = records(spark, sf_dir).join(F.broadcast(maps), "country", "left")  # a row for each country with a map
    return rec.select("code", T.joined(T.apply_map(T.tokens(F.col("name_norm")), F.col("mapping"))).alias("mapped"))


@query("SELECT p_partkey, CASE WHEN left(a, 1) = left(b, 1) AND NOT regexp_matches(a, '^[0-9]+$') AND NOT regexp_matches(b, '^[0-9]+$') AND least(length(a), length(b)) >= 2 AND regexp_matches(l, array_to_string(string_split(s, ''), '.*')) THEN 1 ELSE 0 END AS compatible FROM (SELECT *, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS l FROM (SELECT p_partkey, string_split(p_name, ' ')[1] AS a, string_split(p_name, ' ')[2] AS b FROM part))")
def abbreviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.split("p_name", " ")
    return table(spark, sf_dir, "part").select("p_partkey", F.coalesce(T.abbreviation_compatible(F.try_element_at(w, F.lit(1)), F.try_element_at(w, F.lit(2))), F.lit(False)).cast("int").alias("compatible"))


# ---- joins ----


@query("SELECT o.o_orderkey, c.c_custkey, c.c_mktsegment FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey")
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")


@query("SELECT c.c_custkey, count(o.o_orderkey) AS n FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey")
def join_left_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(n, "c_custkey", "left").na.fill(0, ["n"])


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)")
def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(big, "c_custkey", "left_semi")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey").join(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("SELECT l_orderkey, l_linenumber, CAST(EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size > 25) AS INTEGER) AS large FROM lineitem l")
def join_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), F.lit(1).alias("large")).dropDuplicates(["l_partkey"])
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(large, "l_partkey", "left").select("l_orderkey", "l_linenumber", F.coalesce("large", F.lit(0)).alias("large"))


@query(f"WITH {REC},{TRUTH} SELECT t.s1, t.cand, a.name_raw AS a_name, b.name_raw AS b_name FROM truth t JOIN rec a ON a.code = t.s1 JOIN rec b ON b.code = t.cand")
def pair_attribute_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = records(spark, sf_dir)
    a, b = (rec.select(F.col("code").alias(k), F.col("name_raw").alias(n)) for k, n in (("s1", "a_name"), ("cand", "b_name")))
    return truth(rec).join(a, "s1").join(b, "cand").select("s1", "cand", "a_name", "b_name")


@query(f"""WITH {REC},{TRUTH}, hit AS (SELECT a.code AS s1, b.code AS cand FROM rec a JOIN rec b ON b.country = a.country AND b.name_norm = a.name_norm WHERE a.source = 1 AND b.source <> 1 AND a.name_norm <> '')
SELECT (SELECT count(*) FROM hit) AS hits, (SELECT count(*) FROM hit h JOIN truth t ON t.s1 = h.s1 AND t.cand = h.cand) AS correct, (SELECT count(*) FROM truth) AS positives, (SELECT count(DISTINCT name_norm) FROM rec) AS distinct_names""")
def exact_name_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = records(spark, sf_dir)
    key = ["country", "name_norm"]
    counts = rec.where("name_norm <> ''").groupBy(*key).agg(F.count_if(F.col("source") == 1).alias("n1"), F.count_if(F.col("source") != 1).alias("n2"))  # the number of hits needs no pairs
    good = truth(rec.where("name_norm <> ''")).agg(F.count(F.lit(1)).alias("correct"))
    one = counts.agg(F.coalesce(F.sum(F.col("n1") * F.col("n2")), F.lit(0)).alias("hits"))
    return one.crossJoin(good).crossJoin(truth(rec).agg(F.count(F.lit(1)).alias("positives"))).crossJoin(rec.agg(F.count_distinct("name_norm").alias("distinct_names")))  # one row each


# ---- set operations, lists ----


@query("SELECT c_custkey AS k, 'c' AS kind FROM customer UNION ALL SELECT s_suppkey, 's' FROM supplier")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit("c").alias("kind")).unionByName(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.lit("s").alias("kind")))


@query("SELECT c_nationkey AS n FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n")).unionByName(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n"))).distinct()


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT s_suppkey FROM supplier")
def intersect_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).intersect(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def except_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")))


@query("SELECT conv_id, unnest(string_split(text, ',')) AS part FROM conversations WHERE text <> ''")
def explode_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where("text <> ''").select("conv_id", F.explode(F.split("text", ",")).alias("part"))


@query("SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles, max(turn) AS last_turn FROM conversations GROUP BY conv_id")
def ordered_string_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = F.array_sort(F.collect_list(F.struct("turn", "role")))  # a conversation's turns
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(lists, lambda x: x["role"]), ",").alias("roles"), F.max("turn").alias("last_turn"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS r FROM lineitem) WHERE r <= 2")
def topk_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    r = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.col("l_extendedprice").desc(), "l_linenumber"))
    return table(spark, sf_dir, "lineitem").withColumn("r", r).where("r <= 2").select("l_orderkey", "l_linenumber", "l_extendedprice")


# ---- aggregates and profiles ----


def _flag_sql(pattern: str) -> str:
    return f"CAST(regexp_matches(x, {q(pattern)}) AS INTEGER)"


#: Patterns without lookbehind, which DuckDB's engine lacks; those with one are in noise_patterns_all, which has no SQL.
_PLAIN = {k: p for k, p in {**{f"name_{k}": v for k, v in T.NAME_PATTERNS.items()}, **{f"addr_{k}": v for k, v in T.ADDR_PATTERNS.items()}}.items() if "(?<" not in p and "(?!" not in p}


@query(f"SELECT CASE WHEN grouping(lang) = 1 THEN 'ALL' ELSE lang END AS lang, count(*) AS n, {', '.join(f'round(avg({k}), 6) AS {k}' for k in _PLAIN)} FROM (SELECT lang, {', '.join(f'{_flag_sql(p)} AS {k}' for k, p in _PLAIN.items())} FROM (SELECT lang, coalesce(text, '') AS x FROM documents)) GROUP BY ROLLUP (lang)")
def noise_patterns_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("lang", F.coalesce("text", F.lit("")).alias("x"))
    return R.group_rates(d, "lang", {k: T.flag(F.col("x"), p) for k, p in _PLAIN.items()})


@query()
def noise_patterns_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = records(spark, sf_dir)
    flags = {f"name_{k}": T.flag(F.col("name_raw"), p) for k, p in T.NAME_PATTERNS.items()} | {f"addr_{k}": T.flag(F.col("addr_raw"), p) for k, p in T.ADDR_PATTERNS.items()}
    return R.group_rates(rec, "country", flags)


_QS = ", ".join(f"round(quantile_cont(v, {x}), 6) AS p{round(x * 100)}" for x in R.QUANTILES)


@query(f"SELECT lang, round(avg(v), 6) AS mean, {_QS} FROM (SELECT lang, CAST(length(text) AS DOUBLE) AS v FROM documents) GROUP BY lang")
def quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = R.quantiles(table(spark, sf_dir, "documents"), F.char_length("text"), "lang")
    return out.select("lang", *r6(*(c for c in out.columns if c != "lang")))


@query("SELECT l_returnflag, round(median(l_extendedprice), 6) AS median_price FROM lineitem GROUP BY l_returnflag")
def group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(F.median("l_extendedprice"), 6).alias("median_price"))


@query(f"WITH {REC} SELECT country, token, count(*) AS n FROM (SELECT country, unnest({sql_tokens('name_norm')}) AS token FROM rec) GROUP BY 1, 2")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.token_counts(records(spark, sf_dir), T.tokens(F.col("name_norm")), "country")


@query(f"WITH {REC} SELECT country, token, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY n DESC, token) AS rank FROM (SELECT country, token, count(*) AS n FROM (SELECT country, unnest({sql_tokens('addr_norm')}) AS token FROM rec) GROUP BY 1, 2)) WHERE rank <= 30")
def top_tokens_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_n(R.token_counts(records(spark, sf_dir), T.tokens(F.col("addr_norm")), "country"), 30, "country").select("country", "token", "n", F.col("rank").cast("int").alias("rank"))


@query(f"WITH {REC} SELECT country, token, n, round(n / sum(n) OVER (PARTITION BY country), 6) AS share FROM (SELECT country, token, count(*) AS n FROM (SELECT country, ({sql_tokens('name_norm')})[-1] AS token FROM rec WHERE name_norm <> '') GROUP BY 1, 2)")
def last_token_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = records(spark, sf_dir).where("name_norm <> ''").select("country", F.element_at(T.tokens(F.col("name_norm")), -1).alias("token"))
    return R.shares(last.groupBy("country", "token").agg(F.count(F.lit(1)).alias("n")), "country")


@query("SELECT count(*) AS distinct_keys, CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS rows_in_duplicates, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows FROM (SELECT p_name, p_brand, count(*) AS n FROM part GROUP BY 1, 2)")
def duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.duplicate_counts(table(spark, sf_dir, "part"), ["p_name", "p_brand"])


@query("SELECT p_partkey, round(ln(1 + count(*) OVER (PARTITION BY p_name)), 6) AS generic FROM part")
def genericness(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    return table(spark, sf_dir, "part").select("p_partkey", F.round(F.log1p(F.count(F.lit(1)).over(Window.partitionBy("p_name")).cast("double")), 6).alias("generic"))


_EDGES = [-1.0, 20.0, 40.0, 60.0, 80.0, 99.99, 100.0]


@query("SELECT bin, count(*) AS n FROM (SELECT CASE " + " ".join(f"WHEN value > {a} AND value <= {b} THEN CAST({b} AS DOUBLE)" for a, b in zip(_EDGES, _EDGES[1:], strict=False)) + " END AS bin FROM events) WHERE bin IS NOT NULL GROUP BY bin")
def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.histogram(table(spark, sf_dir, "events"), F.col("value"), _EDGES)


CARD = "card AS (SELECT e.code AS s1, e.country, count(t.cand) AS card, count(CASE WHEN t.cand // 10000000000 = 2 THEN 1 END) AS n2, count(CASE WHEN t.cand // 10000000000 = 3 THEN 1 END) AS n3 FROM rec e LEFT JOIN truth t ON t.s1 = e.code WHERE e.source = 1 GROUP BY 1, 2)"


def _cards(rec: DataFrame) -> DataFrame:
    n = truth(rec).groupBy("s1").agg(F.count(F.lit(1)).alias("card"), F.count_if(T.source_of(F.col("cand")) == 2).alias("n2"), F.count_if(T.source_of(F.col("cand")) == 3).alias("n3"))
    return rec.where("source = 1").select(F.col("code").alias("s1"), "country").join(n, "s1", "left").na.fill(0, ["card", "n2", "n3"])


@query(f"WITH {REC},{TRUTH},{CARD} SELECT country, CAST(least(card, 8) AS BIGINT) AS card, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY country), 6) AS share FROM card GROUP BY country, least(card, 8)")
def cardinality_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cards(records(spark, sf_dir)).groupBy("country", F.least("card", F.lit(8)).alias("card")).agg(F.count(F.lit(1)).alias("n"))
    return R.shares(c, "country").select("country", F.col("card").cast("long").alias("card"), "n", "share")


@query(f"WITH {REC},{TRUTH},{CARD} SELECT s1, country || '|' || CAST(least(card, 6) AS VARCHAR) AS stratum, CASE WHEN card >= 6 THEN '6+' ELSE CAST(card AS VARCHAR) END AS bucket FROM card")
def strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cards(records(spark, sf_dir)).select("s1", T.stratum_key(F.col("country"), F.col("card")).alias("stratum"), T.cardinality_bucket(F.col("card")).alias("bucket"))


@query(f"WITH {REC},{TRUTH},{CARD} SELECT count(CASE WHEN n2 > 0 AND n3 = 0 THEN 1 END) AS only_s2, count(CASE WHEN n2 = 0 AND n3 > 0 THEN 1 END) AS only_s3, count(CASE WHEN n2 > 0 AND n3 > 0 THEN 1 END) AS both, count(CASE WHEN n2 = 0 AND n3 = 0 THEN 1 END) AS none FROM card")
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.source_mix(_cards(records(spark, sf_dir)))


@query(f"WITH {REC},{TRUTH}, c AS (SELECT country, count(CASE WHEN source = 1 THEN 1 END) AS n1, count(CASE WHEN source <> 1 THEN 1 END) AS n23 FROM rec GROUP BY country), p AS (SELECT count(*) AS positives FROM truth) SELECT CAST(sum(n1 * n23) AS BIGINT) AS same_country, CAST(sum(n1) * sum(n23) AS BIGINT) AS full_product, any_value(positives) AS positives, round((sum(n1 * n23) - any_value(positives)) / nullif(any_value(positives), 0), 6) AS negatives_per_positive FROM c, p")
def pair_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = records(spark, sf_dir)
    return R.pair_space(rec, truth(rec))


@query("SELECT count(*) AS n, CAST(count(*) - count(DISTINCT c_name) AS BIGINT) AS duplicate_ids, count(CASE WHEN c_name <> '' AND NOT starts_with(c_name, 'Customer#') THEN 1 END) AS bad_prefix, count(CASE WHEN coalesce(c_name, '') = '' THEN 1 END) AS empty_id, count(CASE WHEN coalesce(c_mktsegment, '') = '' THEN 1 END) AS empty_country FROM customer")
def integrity_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.integrity(table(spark, sf_dir, "customer"), "c_name", "Customer#", "c_mktsegment")


@query("""SELECT count(*) AS rows, count(DISTINCT o_custkey) AS entities, count(CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer) THEN 1 END) AS unknown_s1, count(CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) THEN 1 END) AS unknown_cand,
 CAST(count(*) - count(DISTINCT (o_custkey, o_orderkey)) AS BIGINT) AS repeated_pairs, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_custkey) > 1)) AS shared_cand, (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) AS s1_without_match FROM orders""")
def truth_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("s1"), F.col("o_orderkey").alias("cand"))
    return R.truth_integrity(t, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("s1")), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cand")))


@query("SELECT lang, round(avg(CAST(quality = 1 AS INTEGER)), 6) AS good_rate, round(avg(CASE WHEN n_chars > 1000 THEN CAST(quality = 1 AS INTEGER) END), 6) AS long_good_rate, count(*) AS n FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY lang")
def conditional_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    good = (F.col("quality") == 1).cast("int")
    return d.groupBy("lang").agg(F.round(F.avg(good), 6).alias("good_rate"), F.round(F.avg(F.when(F.col("n_chars") > 1000, good)), 6).alias("long_good_rate"), F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, CAST(len(list_filter(string_split(text, chr(9)), lambda t: true)) AS INTEGER) AS fields, CAST(contains(text, '\"') AS INTEGER) AS with_quote FROM documents")
def raw_field_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.split("text", "\t", -1)).alias("fields"), F.contains(F.col("text"), F.lit('"')).cast("int").alias("with_quote"))


@query()
def unicode_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.script_counts(table(spark, sf_dir, "documents"), "text")


@query("SELECT c_nationkey, count(*) AS entities, round(avg(n), 6) AS avg_orders, count(CASE WHEN n = 0 THEN 1 END) AS zero, count(CASE WHEN n = 1 THEN 1 END) AS one, count(CASE WHEN n > 1 THEN 1 END) AS multi, max(n) AS most FROM (SELECT c.c_nationkey, c.c_custkey, count(o.o_orderkey) AS n FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1, 2) GROUP BY c_nationkey")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.sinks import run_report as report

    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("s1"), F.col("c_nationkey").alias("country"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("s1"))
    return report(c, o, o).select(F.col("country").alias("c_nationkey"), "entities", F.col("avg_candidates").alias("avg_orders"), "zero", "one", "multi", F.col("max_matches").alias("most"))


@query("""WITH l AS (SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'S2-' ELSE 'S1-' END || CAST(turn AS VARCHAR), ',' ORDER BY turn) AS ids FROM conversations GROUP BY conv_id)
SELECT 'self_match' AS rule, (SELECT count(*) FROM conversations WHERE role <> 'user') AS n UNION ALL SELECT 'missing_entity', count(*) FROM (SELECT unnest(range(0, (SELECT max(conv_id) + 11 FROM conversations))) AS e) WHERE e NOT IN (SELECT conv_id FROM l)""")
def validate_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.sinks import list_errors

    c = table(spark, sf_dir, "conversations").withColumn("id", F.concat(F.when(F.col("role") == "user", "S2-").otherwise("S1-"), F.col("turn").cast("string")))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "id"))), lambda x: x["id"]), ",")  # a conversation's turns
    lists = c.groupBy(F.col("conv_id").alias("entity")).agg(ids.alias("ids"))
    last = c.agg(F.max("conv_id").alias("m"))
    entities = last.select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") + 10)).alias("entity"))
    return list_errors(lists, entities).where("rule in ('self_match', 'missing_entity')").select("rule", "n")
