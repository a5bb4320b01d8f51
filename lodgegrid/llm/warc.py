"""WARC archives: writing captures, reading them back and assembling transactions.

A capture is three records: a request, a response (or, for a payload stored before, a revisit that
refers to it) and a metadata record. The request and the metadata name the response in
``WARC-Concurrent-To``. Archives are written by Spark's own text writer, whose line end closes each
record, so they go to any file system Spark can write and commit like any other table. They are
read back cut at the version line (uncompressed ones in as many splits as their size gives); ``Content-Length`` says whether
a piece is a whole record. A file in which one is not (a payload that itself holds a version line) is
read again as a whole and cut by the lengths.

Reading joins records: every other record to the capture it names, or that names it, and gives one
nested row per capture. Columns that the caller does not select, payloads above all, are not shuffled.

Cases
-----
* A NULL payload is an empty one. A NULL URL is written as an empty one and read back as NULL. Line
  breaks in a URL are escaped.
* Of equal payloads of at least ``min_revisit`` bytes the record with the smallest page id is the
  response; a NULL page id counts as the largest, and of repeated rows one is the response.
* Pages without an id are captures too; ``refers_to`` is the response's page id, NULL if it has none.
* Captures without a request or metadata have NULL there; others that name no capture are left out.
* A record that is cut off, or has no length, is left out and counted by ``broken_records``; the others of
  its archive are read. A damaged gzip stream ends the job.
* No pages, no records and no rows. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import base64
import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from lodgegrid.session import cut_lineage, scratch_path

# The format's version line and the order of its parts.
VERSION_LINE = "WARC/1.1\r\n"
CREATED = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@F.pandas_udf(StringType())
def base32_sha1(hex_digest: pd.Series) -> pd.Series:
    return hex_digest.map(lambda h: base64.b32encode(bytes.fromhex(h)).decode(), na_action="ignore")


def record_id(*parts: Column) -> Column:
    """A record's URN from what identifies it."""
    h = F.md5(F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4),
        F.substring(h, 21, 12)), F.lit(">"))


def _record(headers: list[tuple[str, Column]], body: Column) -> Column:
    """A record up to its last line feed; headers whose value is NULL are left out."""
    lines = F.concat_ws("\r\n", *[F.concat(F.lit(f"{name}: "), value) for name, value in headers],
                        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")))
    # the writer ends the record with the last line feed
    return F.concat(F.lit(VERSION_LINE), lines, F.lit("\r\n\r\n"), body, F.lit("\r\n\r"))


def capture_records(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """``record``: three WARC records per row of ``pages``."""
    payload = F.coalesce("html", F.lit(""))
    keyed = pages.select(
        "page_id", F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]+", "%0A").alias("url"), payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("sha1"), F.octet_length(payload).alias("size"),
        F.monotonically_increasing_id().alias("row"))
    # the smallest page id of a payload; NULL last, repeated rows in order
    rank = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")
    firsts = keyed.filter(F.col("size") >= min_revisit).groupBy("sha1", "size").agg(F.min(rank).alias("first"))
    firsts = firsts.withColumnsRenamed({"sha1": "first_sha1", "size": "first_size"})
    found = keyed.join(
        firsts, (F.col("sha1") == F.col("first_sha1")) & (F.col("size") == F.col("first_size")), "left")
    own_id = record_id(F.lit("response"), F.col("page_id"), F.col("row"))
    first_id = record_id(F.lit("response"), F.col("first.page_id"), F.col("first.row"))
    revisit = F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))
    digest = F.concat(F.lit("sha1:"), base32_sha1("sha1"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"))
    shared = [("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(CREATED))]
    named = found.withColumns({"own_id": own_id, "revisit": revisit, "digest": digest, "first_id": first_id})
    response = _record([
        ("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", F.col("own_id")), *shared, ("WARC-Payload-Digest", F.col("digest")),
        ("WARC-Refers-To", F.when(F.col("revisit"), F.col("first_id"))),
        ("WARC-Profile", F.when(F.col("revisit"), F.lit(REVISIT_PROFILE))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
    ], F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("payload"))))
    request = _record([
        ("WARC-Type", F.lit("request")), ("WARC-Record-ID", record_id(F.lit("request"), F.col("page_id"), F.col("row"))),
        *shared, ("WARC-Concurrent-To", F.col("own_id")), ("Content-Type", F.lit("application/http; msgtype=request")),
    ], F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\n\r\n")))
    metadata = _record([
        ("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", record_id(F.lit("metadata"), F.col("page_id"), F.col("row"))),
        *shared, ("WARC-Concurrent-To", F.col("own_id")), ("Content-Type", F.lit("application/warc-fields")),
    ], F.concat(
        F.when(F.col("page_id").isNotNull(), F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")))
        .otherwise(F.lit("")),
        F.lit("payload-bytes: "), F.col("size").cast("string"), F.lit("\r\n")))
    return named.select(F.explode(F.array(request, response, metadata)).alias("record"))


def write_archives(pages: DataFrame, path: str, min_revisit: int = 0, compression: str = "gzip") -> None:
    """The archives of ``pages`` below ``path``, one per task."""
    capture_records(pages, min_revisit).write.option("lineSep", "\n").option("compression", compression).text(path)


def _header(name: str) -> Column:
    value = F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(F.length(value) > 0, value)


def cut_records(content: bytes) -> Iterator[tuple[bytes, bool]]:
    """The records of an archive by their lengths, and whether each is whole.

    A record without an end of its head, without a length or shorter than it says is broken; it
    ends where the next version line begins.
    """
    at = content.find(b"WARC/1.")
    while at >= 0:
        start = content.find(b"\r\n", at) + 2
        end = content.find(b"\r\n\r\n", start) if start > 1 else -1
        sizes = [line.split(b":", 1)[1].strip() for line in content[start:max(end, start)].split(b"\r\n")
                 if line.lower().startswith(b"content-length:")]
        stop = end + 4 + int(sizes[0]) if end >= 0 and sizes and sizes[0].isdigit() else -1
        if 0 <= stop <= len(content):
            yield content[start:stop], True
            at = content.find(b"WARC/1.", stop)
        else:
            after = content.find(b"\nWARC/1.", at)
            yield content[at:after if after >= 0 else len(content)], False
            at = after + 1 if after >= 0 else -1


def _cut_by_length(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"]):
            content = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
            out = list(cut_records(content))
            yield pd.DataFrame({"path": path, "record": [r for r, _ in out], "good": [g for _, g in out]})


def _cut_again(spark: SparkSession, path: str, broken: DataFrame) -> DataFrame:
    """``path, record, good`` of the archives in ``broken``, cut by length."""
    files = spark.read.format("binaryFile").load(path).select("path", "content", _plain_path("path").alias("plain"))
    files = files.join(broken.select(_plain_path("broken").alias("plain")), "plain", "left_semi")
    return files.select("path", "content").mapInPandas(_cut_by_length, "path string, record binary, good boolean")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    pieces = spark.read.option("lineSep", VERSION_LINE).text(path).select(
        F.col("value").alias("record"), F.input_file_name().alias("path"))
    return pieces.filter(F.length("record") > 0)


def broken_records(spark: SparkSession, path: str) -> DataFrame:
    """``path, n_broken, bytes``: archives below ``path`` with records that ``read_records`` leaves out."""
    odd = _split(_pieces(spark, path)).filter("NOT whole").select(F.col("path").alias("broken")).distinct()
    return _cut_again(spark, path, odd).filter("NOT good").groupBy("path").agg(
        F.count(F.lit(1)).alias("n_broken"), F.sum(F.octet_length("record")).cast("long").alias("bytes"))


def _plain_path(column: str) -> Column:
    return F.regexp_replace(column, "^[a-z]+:/+", "/")


def _split(df: DataFrame) -> DataFrame:
    """``path, head, rest, size, whole`` from pieces that begin after a version line."""
    text = F.col("record")
    at = F.locate("\r\n\r\n", text)
    cut = df.select(
        "path", F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text).alias("head"),
        F.when(at > 0, F.substring(text, at + 4, F.octet_length(text))).otherwise(F.lit("")).alias("rest"),
        (at > 0).alias("headed")).withColumn("size", _header("Content-Length").try_cast("long"))
    # a whole record is its body and the two line ends after it
    whole = F.col("headed") & (F.octet_length("rest") == F.col("size") + 4)
    return cut.withColumn("whole", F.coalesce(whole, F.lit(False))).drop("headed")


def _fields(cut: DataFrame, kept: dict[str, Column] | None) -> DataFrame:
    # the body's end is found in bytes
    body = F.expr("CASE WHEN octet_length(rest) > size THEN "
                  "CAST(substring(CAST(rest AS BINARY), 1, CAST(size AS INT)) AS STRING) ELSE rest END")
    named = cut.select(
        "path", "whole",
        F.lower(_header("WARC-Type")).alias("type"), _header("WARC-Record-ID").alias("id"),
        _header("WARC-Target-URI").alias("uri"), _header("WARC-Concurrent-To").alias("concurrent_to"),
        _header("WARC-Refers-To").alias("refers_to"),
        F.regexp_replace(_header("WARC-Payload-Digest"), "^sha1:", "").alias("digest"), body.alias("body"))
    return named.withColumns(kept) if kept else named


def read_records(spark: SparkSession, path: str, kept: dict[str, Column] | None = None) -> DataFrame:
    """``type, id, uri, concurrent_to, refers_to, digest, body`` of every record below ``path``.

    ``kept`` names columns to compute from these, ``body`` among them; the records are then written
    once in that form, so that joins on them do not read the archives again. Records that are cut off
    or have no length are left out; ``broken_records`` counts them.
    """
    found = _fields(_split(_pieces(spark, path)), kept)
    if kept:
        found = cut_lineage(found, "records")
    broken = cut_lineage(found.filter("NOT whole").select(F.col("path").alias("broken")).distinct(), "broken-archives")
    records = found.filter("whole").join(broken, F.col("path") == F.col("broken"), "left_anti")
    if not broken.isEmpty():
        again = _cut_again(spark, path, broken).filter("good").select(
            F.lit("").alias("path"), F.col("record").cast("string").alias("record"))
        records = records.unionByName(_fields(_split(again), kept))
    return records.drop("path", "whole")


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``id, type, uri, digest, refers_to, body, request, metadata``.

    A request or metadata record belongs to the capture that it names in ``concurrent_to`` or that
    names it. ``request`` is the one with the smallest id, ``metadata`` an array by id.
    """
    captures = records.filter(F.col("type").isin("response", "revisit"))
    others = records.filter(F.col("type").isin("request", "metadata")).select(
        F.struct("id", "type", "uri", "body").alias("record"), F.col("id").alias("other_id"), "concurrent_to")
    forward = others.filter("concurrent_to IS NOT NULL").select(F.col("concurrent_to").alias("capture"), "record")
    named = captures.filter("concurrent_to IS NOT NULL").select(F.col("id").alias("capture"), "concurrent_to")
    backward = others.drop("concurrent_to").join(
        named, F.col("other_id") == F.col("concurrent_to")).select("capture", "record")
    grouped = forward.union(backward).groupBy("capture").agg(
        F.min(F.when(F.col("record.type") == "request", F.col("record"))).alias("request"),
        F.array_sort(F.collect_set(F.when(F.col("record.type") == "metadata", F.col("record")))).alias("metadata"))
    return captures.join(grouped, F.col("id") == F.col("capture"), "left").drop("capture", "concurrent_to")


def http_payload(body: Column) -> Column:
    """The body after the HTTP head."""
    body = F.col(body) if isinstance(body, str) else body
    return F.substring(body, F.locate("\r\n\r\n", body) + 4, F.octet_length(body))


def field(metadata: Column, name: str) -> Column:
    """The first value of ``name`` in the metadata records' fields."""
    values = F.transform(metadata, lambda m: F.regexp_extract(m["body"], rf"(?:^|\r\n){name}: ([^\r\n]*)", 1))
    found = F.array_remove(values, "")
    return F.get(found, F.lit(0))


def page_captures(pages: DataFrame, path: str, min_revisit: int = 0) -> DataFrame:
    """Writes the archives of ``pages`` to ``path``, reads them back, one row per capture.

  ``page_id, payload_bytes, payload_digest, record_type, refers_to``; a revisit's size and digest are
    those of the payload it refers to.
    """
    write_archives(pages, path, min_revisit)
    payload, is_response = http_payload(F.col("body")), F.col("type") == "response"
    records = read_records(pages.sparkSession, path, {
        "size": F.when(is_response, F.octet_length(payload)),
        "sha1": F.when(is_response, F.sha1(payload.cast("binary"))),
        "body": F.when(F.col("type") == "metadata", F.col("body")),
    })
    captures = cut_lineage(assemble(records).select(
        "id", "type", "refers_to", field(F.col("metadata"), "page-id").cast("long").alias("page_id"), "size", "sha1",
    ), "captures")
    firsts = captures.filter("type = 'response'").select(
        F.col("id").alias("first_id"), F.col("page_id").alias("first_page"), F.col("size").alias("first_size"),
        F.col("sha1").alias("first_sha1"))
    found = captures.join(firsts, F.col("refers_to") == F.col("first_id"), "left")
    return found.select(
        "page_id", F.coalesce("size", "first_size").cast("long").alias("payload_bytes"),
        base32_sha1(F.coalesce("sha1", "first_sha1")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("first_page").alias("refers_to"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return page_captures(spark.read.parquet(f"{folder}/pages.parquet"), scratch_path(spark, "warc"))


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS hex,
             min(page_id) OVER (PARTITION BY payload) AS first_page FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + ((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT)
                      >> CAST(5 * (3 - i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM h
"""
