"""Sources: delimited record tables without quoting or type inference, label lists, raw lines, Parquet copies."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import encode_id

SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
TRUTH_COLUMNS = ["source1_entity_id", "matched_entity_ids"]


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Tab-separated text with a header: all strings, quotes are text, NA is text, empty fields stay ''. Another header stops the query."""
    header = spark.read.text(path).first()
    found = (header["value"] if header else "").lstrip("﻿").rstrip("\r").split("\t")
    if found != columns:
        raise ValueError(f"{path}: columns are {found}, not {columns}")
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    rows = spark.read.csv(path, sep="\t", header=True, schema=schema, quote="", escape="", encoding="UTF-8", enforceSchema=True)
    return rows.select(*(F.coalesce(c, F.lit("")).alias(c) for c in columns))


def source_path(root: str, split: str, source: int) -> str:
    return f"{root}/{split}/source{source}.tsv"


def load_source(spark: SparkSession, root: str, split: str, source: int) -> DataFrame:
    if source not in (1, 2, 3):
        raise ValueError(f"no source {source}")
    return read_tsv(spark, source_path(root, split, source), SOURCE_COLUMNS).withColumn("source", F.lit(source))


def load_all_sources(spark: SparkSession, root: str, split: str) -> DataFrame:
    one, two, three = (load_source(spark, root, split, k) for k in (1, 2, 3))
    return one.unionByName(two).unionByName(three)


def load_ground_truth(spark: SparkSession, root: str) -> DataFrame:
    return read_tsv(spark, f"{root}/train/ground_truth.tsv", TRUTH_COLUMNS)


def truth_pairs(truth: DataFrame) -> DataFrame:
    """s1, cand: one row for each listed id."""
    ids = truth.where(F.col("matched_entity_ids") != "").select("source1_entity_id", F.explode(F.split("matched_entity_ids", ",")).alias("id"))
    return ids.select(encode_id(F.col("source1_entity_id")).alias("s1"), encode_id(F.trim("id")).alias("cand"))


def cached(spark: SparkSession, path: str, columns: list[str], cache: str, refresh: bool = False) -> DataFrame:
    """A Parquet copy under a name made of path, size, time and columns of the file; written once, then read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    status = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop)
    key = hashlib.sha256(f"{path}|{status.getLen()}|{status.getModificationTime()}|{columns}".encode()).hexdigest()[:16]
    copy = f"{cache}/{key}"
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{copy}/_SUCCESS")
    if refresh or not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        read_tsv(spark, path, columns).write.mode("overwrite").parquet(copy)
    return spark.read.parquet(copy)


def write_partitioned(records: DataFrame, path: str) -> None:
    """One folder for each country, so that scans of a country read no other."""
    records.write.mode("overwrite").partitionBy("country").parquet(path)


def read_partition(spark: SparkSession, path: str, country: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(path).where(F.col("country") == country).select(*columns)


def countries(records: DataFrame) -> DataFrame:
    return records.select("country").distinct().orderBy("country")


def raw_line_check(spark: SparkSession, path: str, n_fields: int = 4) -> tuple[DataFrame, DataFrame]:
    """Counts over raw lines (n_lines, with_quote, with_cr, bad_fields, has_bom), and up to five lines with another number of fields."""
    lines = spark.read.text(path, lineSep="\n").withColumn("fields", F.size(F.split("value", "\t", -1)))
    counts = lines.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("value").contains('"')).alias("with_quote"), F.count_if(F.col("value").contains("\r")).alias("with_cr"), F.count_if(F.col("fields") != n_fields).alias("bad_fields"), F.coalesce(F.bool_or(F.col("value").startswith("﻿")), F.lit(False)).alias("has_bom"))
    return counts, lines.where(F.col("fields") != n_fields).orderBy("value").limit(5)


def field_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").groupBy(F.size(F.split("value", "\t", -1)).alias("fields")).agg(F.count(F.lit(1)).alias("n"))
