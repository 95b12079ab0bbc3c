"""Content-addressed WARC archive.

An archive is two tables: ``headers`` holds the exact header block of every
record, ``payloads`` holds each distinct payload once under its SHA-256. The
records come back through a join on the digest, which is verified on reading.
Equal payloads have one response record; the others revisit it.

Payload bytes move through one shuffle, reduced to one row per payload; the
records join narrow rows only. Copies of one payload are pre-aggregated, and
joins on its digest leave Spark free to split a hot one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navspark.plans.materialize import shuffles_removed
from navspark.session import ensure_checkpoint_dir

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
WARC_DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a hexadecimal string whose length is a multiple of five (SHA-1: 40 to 32)."""
    groups = F.transform(
        F.sequence(F.lit(0), (F.length(digest) / 5 - 1).cast("int")),
        lambda i: F.conv(F.substr(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int"),
    )
    letters = F.transform(
        groups,
        lambda g: F.concat(
            *[F.substr(F.lit(BASE32), F.shiftright(g, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        ),
    )
    return F.array_join(letters, "")


def _record_id(page_id: Column, url: Column) -> Column:
    h = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("")), F.coalesce(url, F.lit(""))))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def build_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One row per page: its record's header block and payload digests, no payload bytes.

    Of the pages with equal payloads of at least ``min_bytes`` bytes the one
    with the largest page_id is the response and the others revisit it;
    smaller payloads are all responses. Null html is an empty payload. Rows
    that repeat the response's page_id are responses too. A null page_id never
    beats another; if all are null, all are responses. A null url is left out of the header.
    """
    p = pages.select(
        F.col("page_id"), F.col("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    ).select(
        "page_id",
        "url",
        F.sha2("payload", 256).alias("payload_sha256"),
        F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
    )
    first = p.groupBy("payload_sha256").agg(F.max("page_id").alias("response_id"))
    r = p.join(first, "payload_sha256")
    is_response = (F.col("payload_bytes") < min_bytes) | F.col("page_id").eqNullSafe(F.col("response_id"))
    r = r.withColumn("record_type", F.when(is_response, "response").otherwise("revisit")).withColumn(
        "refers_to", F.when(~is_response, F.col("response_id"))
    )
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    digest = F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("url"))),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")), F.lit("")),
        line("WARC-Date", F.lit(WARC_DATE)),
        line("WARC-Payload-Digest", digest),
        F.coalesce(line("WARC-Refers-To-Page", F.col("refers_to").cast("string")), F.lit("")),
        line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        line("Content-Length", F.when(is_response, F.col("payload_bytes")).otherwise(F.lit(0)).cast("string")),
        F.lit(CRLF),
    )
    return r.select("page_id", "record_type", "refers_to", "payload_sha256", header.alias("header"))


def build_payloads(pages: DataFrame) -> DataFrame:
    """``(payload_sha256, payload)``, each distinct payload once."""
    p = pages.select(F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    return p.withColumn("payload_sha256", F.sha2("payload", 256)).dropDuplicates(["payload_sha256"]).select(
        "payload_sha256", "payload"
    )


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0) -> str:
    """Write the two tables of an archive under a new folder ``path``."""
    with shuffles_removed(pages.sparkSession):
        build_records(pages, min_bytes).write.parquet(f"{path}/headers")
        build_payloads(pages).write.parquet(f"{path}/payloads")
    return path


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The payload store; a payload that does not match its digest fails the job."""
    p = spark.read.parquet(f"{path}/payloads")
    good = F.sha2("payload", 256) == F.col("payload_sha256")
    return p.withColumn(
        "payload_sha256",
        F.when(good, F.col("payload_sha256")).otherwise(
            F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("payload_sha256")))
        ),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, record_type, refers_to, header, payload)`` of every record.

    ``payload`` is the full payload, for revisits as well.
    """
    return (
        spark.read.parquet(f"{path}/headers")
        .join(read_payloads(spark, path), "payload_sha256")
        .select("page_id", "record_type", "refers_to", "header", "payload")
    )


def original_records(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_sha256, value)``: every record as it was archived, as WARC
    text less its last line break: header, block, line break.

    Responses get their block from the payload store, one row of it each;
    revisits have none, so a payload's copies never multiply its bytes.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = read_payloads(spark, path).withColumnRenamed("payload_sha256", "digest")
    own = (headers["payload_sha256"] == payloads["digest"]) & (headers["record_type"] == "response")
    block = F.coalesce(F.decode("payload", "UTF-8"), F.lit(""))
    return headers.join(payloads, own, "left").select(
        "page_id", "payload_sha256", F.concat("header", block, F.lit(CRLF)).alias("value")
    )


def parsed_records(records: DataFrame) -> DataFrame:
    """``header`` and ``block`` (UTF-8 bytes) of each record's ``value``, cut where the
    header's empty line and its Content-Length say; a record they do not fit fails the job."""
    end = F.locate(CRLF + CRLF, F.col("value")) + 3
    cut = records.withColumn("header", F.left("value", end)).withColumn(
        "block", F.encode(F.regexp_replace(F.expr("substr(value, length(header) + 1)"), r"\r\n\z", ""), "UTF-8")
    )
    fits = header_field("Content-Length").cast("bigint") == F.octet_length("block")
    wrong = F.raise_error(F.lit("record is not as long as its header says"))
    return cut.withColumn("block", F.when(fits, F.col("block")).otherwise(wrong.cast("binary"))).drop("value")


def header_field(name: str) -> Column:
    """A field of the column ``header``, empty if it is not there."""
    return F.regexp_extract("header", rf"(?:^|\n){name}: ([^\r\n]*)", 1)


def export_warc(spark: SparkSession, path: str, out: str) -> None:
    """WARC files of an archive, written by Spark's text sink: valid for UTF-8 payloads."""
    original_records(spark, path).select("value").write.option("lineSep", CRLF).text(out)


def archive_digest(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write an archive of ``pages``, rebuild its records, and describe every page from them.

    A response's ``payload_bytes`` and ``payload_digest`` are those of the block
    cut out of its rebuilt record, a revisit's those of the stored payload it
    refers to; both must agree with the record's own header. Payloads of any
    length are stored and read whole; of equal page_ids with equal payloads all
    are responses. An empty table gives an empty result; columns other than
    page_id, url and html are ignored. The archive stays at ``folder``.
    """
    spark = pages.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archive(pages, folder, min_bytes)
    stored = read_payloads(spark, folder).select(
        "payload_sha256",
        F.octet_length("payload").cast("bigint").alias("stored_bytes"),
        base32_of_hex(F.sha1("payload")).alias("stored_digest"),
    )
    parsed = parsed_records(original_records(spark, folder)).select(
        "page_id",
        "payload_sha256",
        "header",
        F.octet_length("block").cast("bigint").alias("block_bytes"),
        base32_of_hex(F.sha1("block")).alias("block_digest"),
    )
    r = parsed.join(stored, "payload_sha256")
    is_response = header_field("WARC-Type") == "response"
    digest = F.when(is_response, F.col("block_digest")).otherwise(F.col("stored_digest"))
    size = F.when(is_response, F.col("block_bytes")).otherwise(F.col("stored_bytes"))
    agrees = (header_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), digest)) & (
        header_field("WARC-Payload-Length").cast("bigint") == size
    )
    refers = header_field("WARC-Refers-To-Page")
    return r.select(
        "page_id",
        size.alias("payload_bytes"),
        F.when(agrees, digest).otherwise(F.raise_error(F.lit("record header does not match its payload"))).alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"),
        F.when(refers != "", refers.cast(pages.schema["page_id"].dataType)).alias("refers_to"),
    )


_LETTERS = " || ".join(
    f"substr('{BASE32}', CAST((CAST('0x' || substr(h, {i * 5 + 1}, 5) AS INTEGER) >> {s}) & 31 AS INTEGER) + 1, 1)"
    for i in range(8)
    for s in (15, 10, 5, 0)
)
WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d"""
