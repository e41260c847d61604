"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op01_bpe, op02_html, op03_jaccard, op04_warc, op05_quality, op06_decontam, op07_orc, op08_urls, op09_licences, op10_counts
from .common import new_folder, table
from .oracles import ORACLES as ORACLES


def op1_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = op01_bpe.encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select("doc_id", F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"), F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op02_html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).withColumn("n_chars", F.char_length("text").cast("long"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03_jaccard.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    op04_warc.write_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    back = op04_warc.read_archive(spark, folder)
    return back.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type", "refers_to")


def op5_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op05_quality.judge(docs, op05_quality.train(docs, table(spark, sf_dir, "labels")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06_decontam.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"), null_ids=True)


def op7_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "orc")
    op07_orc.write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    return op07_orc.document_index(op07_orc.read_tokens(spark, folder))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), op08_urls.labelled_urls(spark)).withColumn("score", F.round("score", 6))


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09_licences.scan(op09_licences.files_of(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))).withColumnRenamed("file_id", "doc_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = op10_counts.store_trees(table(spark, sf_dir, "documents").select("doc_id", "text"), new_folder(spark, "trees"))
    counted = op10_counts.apply_edits(trees.withColumn("edits", op10_counts.sample_edits()))
    leaves = F.size(F.filter(F.slice("tokens", F.floor(F.size("tokens") / 2).cast("int") + 1, F.greatest(F.lit(1), F.size("tokens"))), lambda n: n > 0)).cast("long")
    return counted.select("doc_id", "n_tokens", "n_tokens_edited", F.char_length("text").cast("long").alias("n_chars_edited"), "chars_reencoded", "leaves_reencoded", leaves.alias("n_leaves"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_tree": op1_bpe_tree,
    "op2_html_templates": op2_html_templates,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_warc_archive": op4_warc_archive,
    "op5_quality_crf": op5_quality_crf,
    "op6_decontamination": op6_decontamination,
    "op7_orc_tokens": op7_orc_tokens,
    "op8_url_filter": op8_url_filter,
    "op9_licence_scan": op9_licence_scan,
    "op10_token_counts": op10_token_counts,
}
