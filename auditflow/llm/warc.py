"""WARC archives: written by Spark, read back by a reader that salvages what is whole."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.llm.common import table
from auditflow.llm.salvage import salvage
from auditflow.session import stage, workspace

# Fixed values of the format.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
# Records in one archive at most, so that an archive fits in memory when it is read.
RECORDS = 10_000
FOUND = (
    "path string, start long, end long, reason string, record_type string, record_id string, "
    "refers_to string, payload_length long, payload_digest string, payload binary"
)


def base32_sha1(data: Column) -> Column:
    """SHA-1 in bare upper-case base32: each five hex digits give four letters."""
    digest = F.sha1(data)
    letters = []
    for at in range(0, 40, 5):
        bits = F.conv(F.substring(digest, at + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letter = F.shiftright(bits, shift).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(ALPHABET), letter, F.lit(1)))
    return F.concat(*letters)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, digest, length, refers_to``: revisits name an earlier equal payload.

    Of payloads that are equal and have at least ``least_bytes`` bytes, rows of the smallest page_id
    are responses and all others revisit it. Where no page_id is known in a group, or the payload is
    smaller, every row is a response. A null html is an empty payload. Only digests that occur more
    than once are joined back.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    known = pages.select(
        "page_id", "url", payload.alias("html"),
        base32_sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("length"),
    )
    groups = known.groupBy("digest", "length").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = stage(groups.where((F.col("n") > 1) & (F.col("length") >= least_bytes)), "warc-shared")
    joined = known.join(shared.select("digest", "first"), "digest", "left")
    return joined.select("page_id", "url", "html", "digest", "length", F.when(
        F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")
    ).alias("refers_to"))


def write_warc(records: DataFrame, path: str, most_records: int = RECORDS) -> None:
    """Writes the rows of ``with_revisits`` to archives under ``path``, in one pass without a shuffle.

    Spark's text sink commits whole files, so a lost task leaves no half archive; its line separator
    is what ends a record. Line breaks in a URL are taken out, a null URL leaves its header out.
    """
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">\r\n"))
    revisit = F.col("refers_to").isNotNull()
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("page_id")),
        F.lit(f"WARC-Date: {DATE}\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\r\n]+", ""), F.lit("\r\n")), F.lit("")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name(F.col("refers_to")))).otherwise(""),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("length").cast("string"),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(revisit, "0").otherwise(F.col("length").cast("string")), F.lit("\r\n\r\n"),
        F.when(revisit, "").otherwise(F.col("html")),
    )
    writer = records.select(record.alias("value")).write.option("lineSep", "\r\n\r\n")
    writer.option("maxRecordsPerFile", most_records).text(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Whole records of the archives under ``path``, and a row for each gap between them.

    Archives are plain or have one compressed member per record, and are read one at a time. A gap
    has a ``reason`` and nothing else but its place. Duplicate records come out as often as they are
    there; empty archives give no row. ``payload=False`` leaves the payload null.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split(" ")[0] for c in FOUND.split(", ")]
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                rows = []
                for f in salvage(bytes(content)):
                    digest = f.headers.get("warc-payload-digest", "").removeprefix("sha1:")
                    length = f.headers.get("x-payload-length") or (None if f.reason else str(len(f.payload)))
                    rows.append((
                        file, f.start, f.end, f.reason, f.headers.get("warc-type"), f.headers.get("warc-record-id"),
                        f.headers.get("warc-refers-to"), int(length) if length and length.isdigit() else None,
                        digest or None, f.payload if payload and not f.reason else None,
                    ))
                    if len(rows) >= 1_000:
                        yield _frame(rows, names)
                        rows = []
                yield _frame(rows, names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(read, FOUND)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"start": "Int64", "end": "Int64", "payload_length": "Int64"})


def _page(name: str) -> Column:
    return F.nullif(F.regexp_extract(name, "^<urn:page:(.*)>$", 1), F.lit("")).cast("long")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the archives have it, after a round trip over all pages."""
    path = workspace(spark, "warc")
    write_warc(with_revisits(table(spark, sf_dir, "pages").select("page_id", "url", "html")), path)
    records = read_warc(spark, path, payload=False).where("reason is null")
    return records.select(
        _page("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        _page("refers_to").alias("refers_to"),
    )


OP8_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS hex FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM d
)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    ((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
