"""Content-addressed WARC archive.

``write_archive`` keeps two Parquet datasets under one root: ``headers`` holds
every record's exact header bytes and the address of its payload, ``payloads``
holds each distinct payload once, addressed by its SHA-256. Records are
rebuilt by joining the two on the address.

Of records with equal payloads of at least ``min_revisit_bytes`` bytes, the one
with the largest page id is the response and the others are revisits of it;
smaller payloads always make responses.

Defined results: null html is an empty payload; a null url is an empty target;
repeated rows of the same page give equal records (all of them responses if
that page is the largest); a null page id never becomes the response while a
page with an id has the same payload; an empty table gives an empty archive;
columns other than the three named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the WARC 1.1 format.
VERSION_LINE = "WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"


def _uri(url: Column) -> Column:
    """A target that fits a header line; line ends and percent signs before hex digits keep their place as escapes."""
    escaped = F.regexp_replace(url, "%(?=0[AD])", "%25")
    return F.replace(F.replace(escaped, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _records(pages: DataFrame, id_col: str, url_col: str, body_col: str) -> DataFrame:
    payload = F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8")
    return pages.select(
        F.col(id_col).alias("page_id"),
        _uri(F.coalesce(F.col(url_col), F.lit(""))).alias("url"),
        payload.alias("payload"),
    ).withColumns({"address": F.sha2("payload", 256), "sha1": F.sha1("payload"), "n_bytes": F.length("payload").cast("long")})


def _header(date: str) -> Column:
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    text = F.concat(
        F.lit(VERSION_LINE),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("response_id"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
        F.lit("\r\n"),
    )
    return F.encode(text, "UTF-8")


def write_archive(
    pages: DataFrame,
    root: str,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    min_revisit_bytes: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write headers and distinct payloads of ``pages`` under ``root``."""
    records = _records(pages, id_col, url_col, body_col)
    slim = records.drop("payload")
    winners = slim.filter(F.col("n_bytes") >= min_revisit_bytes).groupBy("address").agg(F.max("page_id").alias("response_id"))
    headers = slim.join(winners, "address", "left").select("address", _header(date).alias("header"))
    headers.write.option("compression", "zstd").parquet(f"{root}/headers")
    payloads = records.select("address", "payload").groupBy("address").agg(F.first("payload").alias("payload"))
    payloads.write.option("compression", "zstd").parquet(f"{root}/payloads")


def _field(name: str, pattern: str) -> Column:
    return F.regexp_extract("head", rf"\r\n{name}: {pattern}\r\n", 1)


def read_headers(spark: SparkSession, root: str) -> DataFrame:
    """Parsed record headers: page_id, record_type, refers_to, header_digest, block_bytes, and the exact header bytes."""
    heads = spark.read.parquet(f"{root}/headers").withColumn("head", F.decode("header", "UTF-8"))
    number = lambda c: F.when(c != "", c).cast("long")
    return heads.select(
        "address",
        "header",
        number(_field("WARC-Record-ID", "<urn:page:(-?\\d*)>")).alias("page_id"),
        _field("WARC-Type", "(\\w+)").alias("record_type"),
        number(_field("WARC-Refers-To", "<urn:page:(-?\\d*)>")).alias("refers_to"),
        _field("WARC-Payload-Digest", "sha1:(\\w+)").alias("header_digest"),
        _field("Content-Length", "(\\d+)").cast("long").alias("block_bytes"),
    )


def read_payloads(spark: SparkSession, root: str) -> DataFrame:
    """Distinct payloads whose bytes still hash to their address; a damaged payload raises."""
    kept = spark.read.parquet(f"{root}/payloads")
    sound = F.sha2("payload", 256) == F.col("address")
    checked = F.when(sound, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("address"))).cast("binary"))
    return kept.select("address", checked.alias("payload"))


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """Every record with its exact bytes (``record``) and the full payload it stands for (``payload``).

    A header whose digest isn't that of its payload, or whose block has another length than the header says, raises.
    """
    kept = read_payloads(spark, root).withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.length("payload").cast("long")})
    joined = read_headers(spark, root).join(kept, "address")
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    sound = (F.col("header_digest") == F.col("payload_digest")) & (F.col("block_bytes") == F.length("block"))
    record = F.concat("header", "block", F.encode(F.lit(RECORD_END), "UTF-8"))
    damage = F.raise_error(F.concat(F.lit("damaged record of payload "), F.col("address"))).cast("binary")
    return joined.withColumn("block", block).withColumn("record", F.when(sound, record).otherwise(damage)).drop("block")


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """Page, payload and kind of every record, told from the rebuilt record: its header and the digest of what follows it.

    A record whose own bytes don't match its header raises; a revisit's payload is that of its response.
    """
    rows = read_records(spark, root)
    body = F.substr(F.col("record"), F.length("header") + 1, F.length("record") - F.length("header") - len(RECORD_END))
    whole = F.when(F.col("record_type") == "revisit", F.col("payload")).otherwise(body)
    return rows.select("page_id", F.length(whole).cast("long").alias("payload_bytes"), F.sha1(whole).alias("payload_digest"), "record_type", "refers_to")
