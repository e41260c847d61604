"""Documents as records, and the same views as DuckDB SQL.

A record's name is the first line of a document's text, its address all other lines; country is the language, source
1 + doc_id % 3. Two records match when they agree in country and normalised text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import blocking as B
from ..sources.store import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    at = F.locate("\n", F.col("text"))
    source = (1 + F.col("doc_id") % 3).cast("int")
    rec = d.select(
        F.col("lang").alias("country"), source.alias("source"), (source.cast("long") * T.ID_BASE + F.col("doc_id")).alias("code"),
        F.when(at > 0, F.substring("text", F.lit(1), at - 1)).otherwise(F.col("text")).alias("name_raw"),
        F.when(at > 0, F.substring("text", at + 1, F.char_length("text"))).otherwise("").alias("addr_raw"),
    )
    return rec.withColumn("name_norm", T.basic_normalize(F.col("name_raw"))).withColumn("addr_norm", T.basic_normalize(F.col("addr_raw")))


def truth(rec: DataFrame) -> DataFrame:
    """s1, cand: records of source 1 and others with an equal name and address, that aren't empty. Texts are read once and meet by the SHA-256 of both, as neither holds a line end."""
    key = ["country", "text"]
    text = F.unhex(F.sha2(F.concat_ws("\n", "name_norm", "addr_norm"), 256)).alias("text")
    full = stored(rec.where("name_norm <> '' or addr_norm <> ''").select("country", "source", "code", text), "texts")
    a = full.where("source = 1").select(*key, F.col("code").alias("s1"))
    b = full.where("source <> 1").select(*key, F.col("code").alias("cand"))
    return a.join(b, key).select("s1", "cand")


def tokens(rec: DataFrame) -> DataFrame:
    """Name and address tokens with their counts."""
    return B.field_counts(rec, {"n": T.tokens(F.col("name_norm")), "a": T.tokens(F.col("addr_norm"))})


# ---- DuckDB ----


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_fold(x: str) -> str:
    x = f"translate({x}, {q(T.LATIN)}, {q(T.LATIN_TO)})"
    for a, b in T.LATIN_MORE.items():
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def sql_clean(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^0-9a-z]+', ' ', 'g'))"


def sql_norm(x: str) -> str:
    return sql_clean(sql_fold(x))


def sql_tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


REC = f"""
raw AS (
  SELECT lang AS country, CAST(1 + doc_id % 3 AS INTEGER) AS source, (1 + doc_id % 3) * 10000000000 + doc_id AS code, doc_id,
    CASE WHEN instr(t, chr(10)) > 0 THEN substr(t, 1, instr(t, chr(10)) - 1) ELSE t END AS name_raw,
    CASE WHEN instr(t, chr(10)) > 0 THEN substr(t, instr(t, chr(10)) + 1) ELSE '' END AS addr_raw
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
rec AS (SELECT *, {sql_norm('name_raw')} AS name_norm, {sql_norm('addr_raw')} AS addr_norm FROM raw),
sizes AS (SELECT country, count(*) AS n FROM rec GROUP BY country)"""

TRUTH = """
truth AS (SELECT a.code AS s1, b.code AS cand FROM rec a JOIN rec b ON a.country = b.country AND a.name_norm = b.name_norm AND a.addr_norm = b.addr_norm
  WHERE a.source = 1 AND b.source <> 1 AND (a.name_norm <> '' OR a.addr_norm <> ''))"""

TOK = f"""
tok AS (
  SELECT country, code, source, 'n' AS field, unnest({sql_tokens('name_norm')}) AS token FROM rec
  UNION ALL SELECT country, code, source, 'a', unnest({sql_tokens('addr_norm')}) FROM rec)"""


def sql_weights(max_df: float, tok: str = "tok", out: str = "w") -> str:
    """(1 + ln tf) * idf, unit length."""
    return f"""
{out}_tf AS (SELECT country, code, source, field, token, count(*) AS tf FROM {tok} GROUP BY ALL),
{out}_df AS (SELECT t.country, t.field, t.token, count(*) AS df, any_value(s.n) AS n FROM {out}_tf t JOIN sizes s ON s.country = t.country GROUP BY t.country, t.field, t.token HAVING count(*) >= 2 AND count(*) <= {max_df} * any_value(s.n)),
{out}_raw AS (SELECT t.country, t.code, t.source, t.field, t.token, (1 + ln(t.tf)) * (ln((d.n + 1) / (d.df + 1)) + 1) AS x FROM {out}_tf t JOIN {out}_df d ON d.country = t.country AND d.field = t.field AND d.token = t.token),
{out} AS (SELECT country, code, source, field, token, x / sqrt(sum(x * x) OVER (PARTITION BY country, code)) AS w FROM {out}_raw)"""


def sql_topk(weights: str, k: int, out: str = "top") -> str:
    return f"""
{out}_s AS (SELECT a.code AS q, b.code AS c, sum(a.w * b.w) AS score FROM {weights} a JOIN {weights} b ON a.country = b.country AND a.field = b.field AND a.token = b.token WHERE a.source = 1 AND b.source <> 1 GROUP BY a.code, b.code HAVING sum(a.w * b.w) > 0),
{out} AS (SELECT * FROM (SELECT q, c, score, row_number() OVER (PARTITION BY q ORDER BY round(score, 9) DESC, c) - 1 AS rank FROM {out}_s) WHERE rank < {k})"""
