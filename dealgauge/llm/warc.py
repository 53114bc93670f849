"""WARC archives of pages with revisit records for repeated payloads.

Digests of repeated payloads are found without the payloads; the join that marks revisits moves the pages with them. Of records with equal payloads of at least
`MIN_REVISIT_BYTES` bytes the one with the largest page_id is the response, the others become revisit records that refer to
it. Archives are written by Spark's text sink, whose line separator is the end of a WARC record, so they
go to any store that Spark can write; files are gzip, as web archives usually are. They are read back record by record by
content length; what a revisit record lacks comes from its response by a join on the record's id.

Null html is an empty payload; null url has no target header; a null page_id is read back as null, never
is the response of others and is always a response itself; repeated rows of one page are responses both.
An empty table gives an archive without records and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dealgauge.llm.scratch import Scratch

MIN_REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
RECORD_END = "\r\n\r\n"
#: Rows of pages in an archive file.
ARCHIVE_ROWS = 2000
ARCHIVE_BYTES = 32 << 20
READ_SCHEMA = ("page_id long, url string, record_id string, record_type string, refers_to_id string, "
               "payload_bytes long, payload_digest string, header_digest string, html string")


def resolve_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """`pages` with payload_bytes, payload_digest, record_type and refers_to."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    headed = pages.withColumn("payload_bytes", F.length(payload).cast("long")).withColumn("payload_digest", F.sha1(payload))
    shared = (
        headed.filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
        .groupBy(F.col("payload_digest").alias("r_digest"), F.col("payload_bytes").alias("r_bytes"))
        .agg(F.max("page_id").alias("response"), F.count("*").alias("copies")).filter("copies > 1").drop("copies"))
    joined = headed.join(shared, (F.col("payload_digest") == F.col("r_digest")) & (F.col("payload_bytes") == F.col("r_bytes")), "left")
    revisit = F.coalesce(F.col("response") != F.col("page_id"), F.lit(False))
    return joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("response"))).drop("r_digest", "r_bytes", "response")


def _record_id(page_id: Column) -> Column:
    """A urn that follows from the page."""
    hexed = F.md5(F.concat(F.lit("page "), F.coalesce(page_id.cast("string"), F.lit("-"))).cast("binary"))
    parts = [F.substring(hexed, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(resolved: DataFrame) -> DataFrame:
    """One column `value`: each row's record without its end."""
    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value, F.lit("\r\n"))).otherwise("")

    url = F.regexp_replace(F.regexp_replace("url", "[\r\n\x00]", ""), r"^[\x20\t]+|[\x20\t]+$", "")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(F.col("record_type") == "response", F.coalesce(F.col("html"), F.lit(""))).otherwise("")
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"), F.lit("\r\n"),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.when(url != "", url)),
        line("WARC-Page", F.col("page_id").cast("string")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Profile", F.when(F.col("record_type") == "revisit", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        line("WARC-Refers-To", F.when(F.col("refers_to").isNotNull(), _record_id(F.col("refers_to")))),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit("\r\n\r\n"))
    return resolved.select(F.concat(header, http, body).alias("value"))


def write_archives(resolved: DataFrame, path: str, rows: int) -> None:
    """Gzip archive files of at most `rows` records, written where the records are."""
    records(resolved).write.option("lineSep", RECORD_END).option("maxRecordsPerFile", rows).option(
        "compression", "gzip").mode("error").text(path)


def _parse(data: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines)
        at = end + 4
        to = at + int(head["Content-Length"])
        payload = data[data.index(b"\r\n\r\n", at, to) + 4:to]
        if data[to:to + 4] != RECORD_END.encode():
            raise ValueError(f"no end of the record at byte {to}")
        at = to + 4
        whole = head["WARC-Type"] == "response"
        yield (
            int(head["WARC-Page"]) if "WARC-Page" in head else None, head.get("WARC-Target-URI"), head["WARC-Record-ID"],
            head["WARC-Type"], head.get("WARC-Refers-To"), len(payload) if whole else None,
            hashlib.sha1(payload).hexdigest() if whole else None, head["WARC-Payload-Digest"].removeprefix("sha1:"),
            payload.decode() if whole else None)


def _read(batches: Iterator[pa.RecordBatch], fields: tuple[str, ...], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    kept = [schema.get_field_index(f) for f in fields]
    for batch in batches:
        for content in batch.column(0):
            rows, size = [], 0
            for row in _parse(gzip.decompress(content.as_buffer())):
                rows.append([row[i] for i in kept])
                size += len(row[-1] or "") if "html" in fields else 0
                if len(rows) >= 1000 or size > 4 << 20:
                    yield _rows(rows, fields, schema)
                    rows, size = [], 0
            if rows:
                yield _rows(rows, fields, schema)


def _rows(rows: list, fields: tuple[str, ...], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, schema.field(f).type) for c, f in zip(zip(*rows), fields)], names=list(fields))


def read_archives(spark: SparkSession, path: str, html: bool = True) -> DataFrame:
    """Records of all archives; payload_digest is computed from the payload that was read."""
    names = [x.strip().split(" ")[0] for x in READ_SCHEMA.split(",")]
    fields = tuple(n for n in names if html or n != "html")
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(x.strip().split(" ")[0], kinds[x.strip().split(" ")[1]]) for x in READ_SCHEMA.split(",")])
    files = spark.read.format("binaryFile").load(path).select("content")
    out = ", ".join(x for x in READ_SCHEMA.split(", ") if html or not x.startswith("html"))
    return files.mapInArrow(lambda batches: _read(batches, fields, schema), out)


def join_originals(read: DataFrame) -> DataFrame:
    """Page rows of read archives: revisit records with the figures of the response that they refer to."""
    originals = read.filter("record_type = 'response' and page_id is not null").groupBy(F.col("record_id").alias("o_id")).agg(
        F.max("page_id").alias("o_page"), F.max("payload_bytes").alias("o_bytes"), F.max("payload_digest").alias("o_digest"))
    revisits = read.filter("record_type = 'revisit'").join(originals, F.col("refers_to_id") == F.col("o_id"), "left")
    return (
        read.filter("record_type = 'response'").select(
            "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"),
            (F.col("payload_digest") == F.col("header_digest")).alias("digest_holds"))
        .unionByName(revisits.select(
            "page_id", F.col("o_bytes").alias("payload_bytes"), F.col("o_digest").alias("payload_digest"), "record_type",
            F.col("o_page").alias("refers_to"), (F.col("o_digest") == F.col("header_digest")).alias("digest_holds"))))


def archive_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes deduplicated archives of `pages`, reads them back and returns a row per page."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    size = pages.agg(F.count("*").alias("n"), F.sum(F.octet_length("html")).alias("b")).first()
    rows = max(1, min(ARCHIVE_ROWS, size["n"] * ARCHIVE_BYTES // max(1, size["b"] or 0)))
    write_archives(resolve_revisits(pages.select("page_id", "url", "html"), min_bytes), f"{scratch.folder}/archives", rows)
    read = scratch.write(read_archives(spark, f"{scratch.folder}/archives", html=False), "records")
    return join_originals(read)
