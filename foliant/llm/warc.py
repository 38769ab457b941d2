"""WARC archive that stores each payload once, under its verified SHA-256.

An archive is two tables in the shared folder:

``headers``   one row per record: exact header bytes and the payload's SHA-256
``payloads``  one row per distinct payload: SHA-256, length, and one gzip member

``read_archive`` joins them and gives back every original record, byte for byte; it
decompresses each payload and fails on a digest that does not agree.

Cases: a null html is an empty payload. A null url leaves its header out; control characters
in a url are percent-encoded, so a header line cannot be forged. Equal payloads: the record with the
largest id is ``response``, the others are ``revisit``; rows that repeat that largest id are all
``response``; a null id is a revisit unless every copy has a null id. Payloads below
``min_revisit_bytes`` are all ``response``. No rows give two empty tables. Further input
columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import new_path, small

#: Digits of base 32 as ``conv`` writes them, and RFC 4648's alphabet.
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RFC32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_SCHEMA = T.StructType(
    [T.StructField("sha256", T.BinaryType()), T.StructField("header", T.BinaryType()), T.StructField("payload", T.BinaryType())]
)


def base32(hex40: Column) -> Column:
    """RFC 4648 base 32 of 20 bytes given as 40 hexadecimal digits."""
    groups = [F.lpad(F.conv(F.substring(hex40, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), CONV32, RFC32)


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def safe_url(url: Column) -> Column:
    """Control characters, which would end a header line, as percent codes."""
    out = url
    for code in (*range(32), 127):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike("[\\x00-\\x1F\\x7F]"), out).otherwise(url)


def plan_records(pages: DataFrame, min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(page_id, sha256, header): one row per page, without payloads.

    Only ids and digests are shuffled here. The join back on the digest is a plain equi-join, so
    adaptive execution splits a digest that very many pages share.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id",
        "url",
        F.unhex(F.sha2(body, 256)).alias("sha256"),
        base32(F.upper(F.sha1(body))).alias("sha1"),
        F.octet_length(body).cast("long").alias("n"),
    )
    owners = rows.groupBy("sha256").agg(F.max("page_id").alias("owner"))
    rows = rows.join(owners, "sha256", "left")
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner")) & (F.col("n") >= min_revisit_bytes)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", safe_url(F.col("url"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", record_id(F.col("owner"))))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.col("n").cast("string")),
        F.lit("\r\n"),
    )
    return rows.select("page_id", "sha256", header.cast("binary").alias("header"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """html to (sha256, n, gzip member)."""
    for b in small(batches):
        raw = [x.encode() if isinstance(x, str) else (x or b"") for x in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([hashlib.sha256(x).digest() for x in raw], pa.binary()),
                pa.array([len(x) for x in raw], pa.int64()),
                pa.array([gzip.compress(x, 6, mtime=0) for x in raw], pa.binary()),
            ],
            ["sha256", "n", "member"],
        )


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """Write the two tables of the archive of ``pages`` (page_id, url, html) below ``path``."""
    plan_records(pages, min_revisit_bytes).write.option("compression", "zstd").parquet(f"{path}/headers")
    packed = pages.select("html").mapInArrow(_pack, "sha256 binary, n long, member binary")
    # partial aggregation keeps one copy of a payload per task before anything is shuffled
    once = packed.groupBy("sha256").agg(F.first("n").alias("n"), F.first("member").alias("member"))
    once.write.option("compression", "none").parquet(f"{path}/payloads")


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decompress and verify; (sha256, header, payload)."""
    for b in small(batches):
        out = []
        for sha, n, member in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            if member is None:
                raise ValueError(f"archive has no payload {sha.hex()}")
            raw = gzip.decompress(member)
            if len(raw) != n or hashlib.sha256(raw).digest() != sha:
                raise ValueError(f"payload {sha.hex()} is damaged")
            out.append(raw)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["sha256", "header", "payload"])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, header, payload) of every record, payload verified. A record's bytes are header + payload + CRLF CRLF."""
    headers = spark.read.schema("page_id long, sha256 binary, header binary").parquet(f"{path}/headers")
    payloads = spark.read.schema("sha256 binary, n long, member binary").parquet(f"{path}/payloads")
    return headers.join(payloads, "sha256", "left").select("sha256", "header", "n", "member").mapInArrow(_unpack, ARCHIVE_SCHEMA)


def header_field(name: str) -> Column:
    found = F.regexp_extract(F.col("header").cast("string"), f"(?:^|\\n){name}: ([^\\r\\n]*)\\r\\n", 1)
    return F.when(found == "", None).otherwise(found)


def export_warc(records: DataFrame, path: str, records_per_file: int = 20_000) -> None:
    """Write reconstructed records as gzip-compressed WARC files. The line separator of Spark's text
    writer is the end of a record, so payload bytes go out as they are."""
    rec = F.concat(F.col("header"), F.col("payload")).cast("string").alias("value")
    records.select(rec).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def op1(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """What the archive of ``pages`` says once it is read back."""
    path = new_path(spark, "warc")
    write_archive(pages.select("page_id", "url", "html"), path)
    page_of = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1)
    number = lambda c: F.when(c == "", None).otherwise(c).cast("long")
    got = read_archive(spark, path)
    return got.select(
        number(page_of(header_field("WARC-Record-ID"))).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32(F.upper(F.sha1("payload"))).alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"),
        number(page_of(header_field("WARC-Refers-To"))).alias("refers_to"),
        header_field("WARC-Target-URI").alias("target_uri"),
    )


OP1_SQL = """
WITH p AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, url, octet_length(body)::BIGINT AS payload_bytes, sha256(body) AS k, upper(sha1(body)) AS h FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY k) AS owner FROM d
), b AS (
  SELECT *, list_transform(range(8), lambda i: ('0x' || substr(h, (5 * i + 1)::INT, 5))::INT) AS v FROM g
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(v, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 15) & 31) + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 10) & 31) + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 5) & 31) + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN owner IS NULL OR page_id IS NOT DISTINCT FROM owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN owner IS NULL OR page_id IS NOT DISTINCT FROM owner THEN NULL ELSE owner END AS refers_to,
  CASE WHEN url = '' THEN NULL ELSE url END AS target_uri
FROM b
"""
