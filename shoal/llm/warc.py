"""Web archives in which a repeated payload is stored once.

Headers (page, digest, length) are shuffled by payload digest to find the original
of each payload; the payloads themselves are shuffled once, by page. Every record
gets fresh headers: the original is a ``response`` with its payload, the others are
``revisit`` records that name the original. Archives are written and read with
Spark's own text and binary sources, so any store that Spark reaches will do, and a
lost task leaves no half archive. A file is one gzip stream of WARC/1.1 records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.session import scratch_path

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of the payload as 32 upper-case base-32 digits: 40 bits at a time."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _HEX32, _BASE32)


def _record_id(page_id: Column, digest: Column) -> Column:
    """A name-based id: the same page and payload give the same one in every run."""
    text = F.md5(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("none")), digest).cast("binary"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(text, a, n) for a, n in cuts]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; none where the value is null. Line ends inside a value are escaped."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html`` with ``digest, bytes`` and the original's ``refers_to, refers_url`` (null for responses).

    Of equal payloads of ``min_bytes`` or more the smallest page_id is the original. A null payload is empty. Rows
    without a page_id are never an original; they refer to one where there is one. Rows that repeat both the
    original's id and its payload are responses as it is.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html").cast("long"))
    heads = rows.select("page_id", "url", "digest", "bytes")
    first = (heads.filter((F.col("bytes") >= min_bytes) & F.col("page_id").isNotNull()).groupBy("digest")
             .agg(F.min(F.struct("page_id", "url")).alias("first")))
    again = (heads.select("page_id", "digest").distinct().join(first, "digest")
             .filter(~F.col("page_id").eqNullSafe(F.col("first.page_id")))
             .select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"),
                     F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url")))
    return rows.join(again, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")),
                     "left").drop("_page", "_digest")


def records(resolved: DataFrame, date: str) -> Column:
    """One WARC record per row, without the two line ends behind it."""
    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("html")))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))), _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Refers-To", F.when(again, _record_id(F.col("refers_to"), F.col("digest")))),
        _line("WARC-Refers-To-Target-URI", F.when(again, F.col("refers_url"))),
        _line("WARC-Profile", F.when(again, F.lit(PROFILE))), _line("Page-Id", F.col("page_id").cast("string")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(CRLF), block)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                   records_per_file: int = 20_000) -> None:
    """Write all pages as archives under ``folder``; the line ends behind a record separate the records."""
    (resolve(pages, min_bytes).select(records(pages, date).alias("value")).write
     .option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(folder))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of one archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = dict(line.decode().split(": ", 1) for line in lines)
        size = int(head["Content-Length"])
        yield head, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Records of the archives: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``.

    A response's digest is computed from its payload and must be the one its header tells. A revisit is joined to
    its original by record id and digest. ``with_payload`` adds ``payload``: null for revisits.
    """
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "record_id", "refers", "payload"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for head, block in parse(gzip.decompress(content)):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(http.rsplit(b" ", 1)[1])
                    if head["WARC-Type"] == "response":
                        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != size:
                            raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its header")
                    else:
                        payload = None
                    page = head.get("Page-Id")
                    rows.append((None if page is None else int(page), head.get("WARC-Target-URI"), size, digest,
                                 head["WARC-Type"], head["WARC-Record-ID"], head.get("WARC-Refers-To"),
                                 payload if with_payload else None))
                frame = pd.DataFrame(rows, columns=names)
                frame["page_id"] = frame["page_id"].astype("Int64")
                yield frame

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    rows = files.select("content").mapInPandas(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, record_id string,"
             " refers string, payload binary")
    originals = (rows.filter("record_type = 'response'").groupBy("record_id", "payload_digest")
                 .agg(F.min("page_id").alias("refers_to"))
                 .select(F.col("record_id").alias("_id"), F.col("payload_digest").alias("_digest"), "refers_to"))
    found = rows.join(originals, (F.col("refers") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left")
    return found.select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to",
                        *(["payload"] if with_payload else []))


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the archives to the shared folder and read them back. An empty table gives no rows."""
    spark, folder = pages.sparkSession, scratch_path(pages.sparkSession, "warc")
    write_archives(pages, folder, min_bytes)
    return read_archives(spark, folder)
