"""Corpus pipeline: quality rules, near-duplicate removal, benchmark decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared folder and gives
it, read again, to the next one. All stages but the last return the columns of documents.

1. quality: documents that the quality rules reject go.
2. near_duplicates: one document of each group of the n-gram Jaccard join stays, the one whose id names the group; rows that
   repeat this id and its text are one document. Sets of NEAR_WIDTH words, similarity NEAR_PERCENT or more.
3. decontamination: documents with a word inside a benchmark window go.
4. token_ids: the documents that are left, encoded and decoded: doc_id, n_tokens, token_ids, decoded_sha256.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftmatch.llm import op01_bpe, op03_jaccard, op05_quality, op06_decontam
from weftmatch.llm.common import stored, table


#: Words of a shingle and similarity from which documents are near duplicates, in this stage.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op05_quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op03_jaccard.keep_one(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op06_decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"), null_ids=True)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = op01_bpe.encode_decode(docs.select("doc_id", "text"))
    return coded.select("doc_id", F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"), "token_ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]

#: SQL has no Viterbi decoding of a trained chain and no BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
