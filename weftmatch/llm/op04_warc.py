"""Content-addressed WARC archive.

An archive is two tables. `payloads` has the bytes of each distinct payload once, under their SHA-256; `records` has the
exact header of each record and the digest of its payload. A join gives back the original records, and what is read from
an archive is parsed from their bytes. Copies are summed up to one row before payloads are shuffled, and headers are joined
to digests without their bytes.

Digests are verified twice. When payloads are written, rows with equal SHA-256 must agree in length and in a second strong
digest, SHA-512; when they are read, the SHA-256 is computed again. A difference stops the job.

Of records with equal payloads of at least MIN_REVISIT bytes, the one with the largest page id is a response, the others
are revisits that refer to it; smaller ones are all responses. Page ids may have any type that orders and casts to text.

Defined results: a null html is an empty payload; rows that repeat the largest page id are all responses; a record with a
null page id is a revisit if another has an id, else a response; a null url is an empty target; line ends in a url are
written as %0D and %0A; other columns of pages are ignored; no rows, an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 1_000
DATE = "2024-01-01T00:00:00Z"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _urn(page_id: Column) -> Column:
    """A null id has no part of its own, an empty one an empty part."""
    return F.coalesce(F.concat(F.lit("<urn:page:"), F.url_encode(page_id.cast("string")), F.lit(">")), F.lit("<urn:page>"))


def _id_of(urn: Column, kind: str) -> Column:
    return F.when(urn.startswith("<urn:page:"), F.url_decode(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1))).cast(kind)


def write_archive(pages: DataFrame, folder: str, date: str = DATE) -> None:
    """Writes folder/payloads and folder/records."""
    spark = pages.sparkSession
    base = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha2("payload", 256))

    second = F.struct(F.octet_length("payload").alias("size"), F.sha2("payload", 512).alias("strong"))
    payloads = base.withColumn("second", second).groupBy("digest").agg(F.first("payload").alias("payload"), F.max("page_id").alias("last_id"), F.min("second").alias("least"), F.max("second").alias("most"))
    same = F.when(F.col("least") == F.col("most"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("different payloads have the digest "), "digest")).cast("binary"))
    payloads.select("digest", same.alias("payload"), "last_id").withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long")).write.parquet(f"{folder}/payloads")

    known = spark.read.parquet(f"{folder}/payloads").select("digest", "sha1", "size", "last_id")
    revisit = F.coalesce((F.col("size") >= MIN_REVISIT) & F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id")), F.lit(False))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Target-URI", url),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("X-Strong-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _urn(F.col("last_id"))), _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("size")).cast("string")),
        F.lit("\r\n"),
    )
    base.select("page_id", "url", "digest").join(known, "digest").select("page_id", header.cast("binary").alias("header"), "digest").write.parquet(f"{folder}/records")


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\n{name}: ([^\r\n]*)\r\n", 1)


def original_records(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, record (its bytes as a WARC file holds them; revisits have an empty block), payload: rebuilt from both tables, digests verified."""
    payloads = spark.read.parquet(f"{folder}/payloads").select("digest", "payload")
    verified = payloads.withColumn("payload", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest "), "digest")).cast("binary")))
    records = spark.read.parquet(f"{folder}/records")
    revisit = F.col("header").cast("string").startswith("WARC/1.1\r\nWARC-Type: revisit\r\n")
    block = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    return records.join(verified, "digest").select("page_id", F.concat("header", block, F.lit("\r\n\r\n").cast("binary")).alias("record"), "payload")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, header, payload (of revisits: that of the response they refer to), record_type, refers_to, payload_digest: parsed from the bytes of the records."""
    rebuilt = original_records(spark, folder)
    kind = rebuilt.schema["page_id"].dataType.simpleString()
    headers = rebuilt.withColumn("head", F.substring_index(F.col("record").cast("string"), "\r\n\r\n", 1))  # up to the first empty line
    headers = headers.withColumn("header", F.concat("head", F.lit("\r\n\r\n"))).withColumn("at", F.octet_length("header"))
    parsed = headers.select("page_id", "header", "record", "at", "payload", _field("WARC-Type").alias("record_type"), _field("WARC-Refers-To").alias("urn"), _field("WARC-Payload-Digest").alias("sha1"), _field("Content-Length").cast("int").alias("length"))
    block = F.expr("substring(record, at + 1, length)")
    return parsed.select(
        "page_id", "header", F.when(F.col("record_type") == "revisit", F.col("payload")).otherwise(block).alias("payload"), "record_type",
        _id_of(F.col("urn"), kind).alias("refers_to"), F.regexp_extract("sha1", "^sha1:(.+)$", 1).alias("payload_digest"),
    )
