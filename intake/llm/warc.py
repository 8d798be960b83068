"""WARC records in a content-addressed archive.

Payload bytes are stored once, compressed, under their SHA-256 and length. Record headers are kept
apart, byte for byte, with the address of their payload. Reading joins the two and gives
each record's exact bytes; what a reader wants to know is parsed out of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

CRLF = "\r\n"
# Fixed values of the format: names of fields and types.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:intake:page:"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"


@F.pandas_udf(BinaryType())
def _packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Each payload as a zstd frame of its own, as archives compress each record."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        yield batch.map(pack)


@F.pandas_udf(BinaryType())
def _unpacked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        yield batch.map(unpack, na_action="ignore")


def _id(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _addressed(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    return pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id",
        "url",
        "payload",
        F.sha2("payload", 256).alias("address"),
        F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("length"),
    )


def write_archive(pages: DataFrame, path: str, smallest_revisit: int = 1000, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes a record for each row (page_id, url, html) to ``path``; other columns are not read.

    Of records with equal payloads of ``smallest_revisit`` bytes or more, the one with
    the largest page_id (null is smallest) is the response and the others revisit it;
    rows that repeat that page_id are responses too, as are all smaller payloads. A null html is an
    empty payload, a null url leaves its field out, and line breaks in a url are
    percent-encoded. Equal addresses with different SHA-1 raise an error. No rows give an empty archive.
    """
    rows = _addressed(pages)
    # Sizes of digests only are shuffled here; counts of equal payloads are summed per task first.
    groups = rows.groupBy("address", "length").agg(
        F.max("page_id").alias("holder"), F.min("sha1").alias("_a"), F.max("sha1").alias("_b")
    )
    groups = groups.select(
        "address",
        "length",
        "holder",
        F.when(F.col("_a") != F.col("_b"), F.raise_error(F.lit("two payloads share a SHA-256")).cast("string")).alias("clash"),
    )
    small = rows.drop("payload").join(groups, ["address", "length"])
    revisit = (F.col("length") >= smallest_revisit) & F.coalesce(~F.col("page_id").eqNullSafe(F.col("holder")), F.lit(False))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(HTTP_HEAD), _field("Content-Length", F.col("length").cast("string")), F.lit(CRLF))
    body = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("length"))
    head = F.concat(
        F.lit(VERSION + CRLF),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _id(F.col("page_id"))),
        _field("WARC-Target-URI", url),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        _field("WARC-Payload-Length", F.col("length").cast("string")),
        F.when(
            revisit,
            F.concat(_field("WARC-Profile", F.lit(REVISIT_PROFILE)), _field("WARC-Refers-To", _id(F.col("holder")))),
        ).otherwise(""),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", body.cast("string")),
        F.lit(CRLF),
        http,
    )
    small.select(
        F.encode(head, "UTF-8").alias("head"),
        F.when(~revisit, F.struct(F.coalesce("clash", "address").alias("address"), "length")).alias("payload"),
    ).write.parquet(f"{path}/heads")
    # Of each payload every task sends one copy at most; equal addresses are equal bytes.
    packed = rows.select("address", "length", _packed("payload").alias("packed"))
    packed.dropDuplicates(["address", "length"]).write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``head``, ``payload`` and ``record`` (the exact bytes of the record) of every record.

    A payload that is missing, or whose bytes are not those of its address, is an error.
    """
    heads = spark.read.schema("head binary, payload struct<address: string, length: bigint>").parquet(f"{path}/heads")
    stored = spark.read.schema("address string, length bigint, packed binary").parquet(f"{path}/payloads")
    heads = heads.select("head", F.col("payload.address").alias("address"), F.col("payload.length").alias("length"))
    joined = heads.join(stored, ["address", "length"], "left")
    joined = joined.select("head", "address", _unpacked("packed").alias("bytes"))
    sound = F.col("address").isNull() | (F.sha2("bytes", 256).eqNullSafe(F.col("address")))
    payload = F.when(sound, F.col("bytes")).otherwise(
        F.raise_error(F.concat(F.lit("payload lost or changed: "), "address")).cast("binary")
    )
    return joined.select("head", payload.alias("payload")).select(
        "head",
        "payload",
        F.concat("head", F.coalesce("payload", F.lit(b"")), F.lit(b"\r\n\r\n")).alias("record"),
    )


def parse_records(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri of records.

    Reads them from the record's own bytes. Ids that are not whole numbers are null. A response's payload is measured and
    hashed anew and must agree with its header; a revisit has its response's figures.
    """
    # The header block ends at the first empty line; a URL has no line breaks.
    head = F.substring_index(F.decode("head", "UTF-8"), CRLF + CRLF, 1)
    value = lambda name: F.nullif(F.regexp_extract(F.col("_head"), f"\r\n{name}: ([^\r]*)", 1), F.lit(""))
    page = lambda name: F.try_to_number(
        F.nullif(F.regexp_extract(value(name), "(-?[0-9]+)>", 1), F.lit("")), F.lit("S9999999999999999999")
    ).cast("long")
    parsed = records.withColumn("_head", head).select(
        page("WARC-Record-ID").alias("page_id"),
        value("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
        value("WARC-Target-URI").alias("target_uri"),
        F.substring_index(value("WARC-Payload-Digest"), ":", -1).alias("_sha1"),
        value("WARC-Payload-Length").cast("long").alias("_length"),
        (F.octet_length("record") - F.octet_length("_head") - 8 - value("Content-Length").cast("long")).alias("_rest"),
        F.coalesce("payload", F.lit(b"")).alias("payload"),
    )
    response = F.col("record_type") == "response"
    sound = (F.col("_rest") == 0) & (
        ~response | ((F.sha1("payload") == F.col("_sha1")) & (F.octet_length("payload") == F.col("_length")))
    )
    return parsed.select(
        "page_id",
        F.when(sound, F.col("_length"))
        .otherwise(F.raise_error(F.lit("a record disagrees with its header")).cast("long"))
        .alias("payload_bytes"),
        F.col("_sha1").alias("payload_digest"),
        "record_type",
        "refers_to",
        "target_uri",
    )
