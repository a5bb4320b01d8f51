import base64
import gzip
import hashlib
import glob

import pytest

from lodgegrid.llm.warc import assemble, http_payload, op10_warc, page_captures, read_records, write_archives

from .conftest import FOLDER


def expected(pages):
    first = {}
    for page_id, _, html in pages:
        h = html or ""
        key = (page_id is None, page_id or 0)
        first[h] = min(first.get(h, key), key)
    seen, out = set(), []
    for page_id, _, html in pages:
        h = html or ""
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        own = (page_id is None, page_id or 0)
        response = own == first[h] and h not in seen
        if response:
            seen.add(h)
        out.append((page_id, len(h.encode()), digest, "response" if response else "revisit",
                    None if response or first[h][0] else first[h][1]))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_small_pages(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    assert result(op10_warc(spark, FOLDER)) == expected(pages)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_odd_pages(spark, tmp_path, compression):
    pages = [
        (5, "http://a/", "same"), (3, "http://b/", "same"), (9, None, None), (8, "http://c/\r\nX: y", ""),
        (7, "http://d/", "line\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
        (1, "http://e/", "ünïcode ✓\r\n" * 5000), (4, "u", "twice"), (4, "u", "twice"), (None, "n", "no id"), (None, "n", "same"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' AS body", "1 AS id")
    from lodgegrid.llm import warc

    path = str(tmp_path / "w")
    original = warc.write_archives
    warc.write_archives = lambda p, at, m: original(p, at, m, compression)
    try:
        assert result(page_captures(df, path)) == expected(pages)
    finally:
        warc.write_archives = original
    rows = assemble(read_records(spark, path)).collect()
    assert len(rows) == len(pages)
    assert all(r.request.type == "request" and [m.type for m in r.metadata] == ["metadata"] for r in rows)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert page_captures(df, str(tmp_path / "w")).count() == 0


def test_archive_is_plain_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://x/", "häy")], "page_id long, url string, html string")
    write_archives(df.coalesce(1), str(tmp_path / "w"))
    data = b"".join(gzip.open(f).read() for f in glob.glob(str(tmp_path / "w" / "*.gz")))
    records = data.split(b"WARC/1.1\r\n")[1:]
    assert len(records) == 3
    for r in records:
        head, body = r.split(b"\r\n\r\n", 1)
        size = int([x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")][0].split()[1])
        assert body[size:] == b"\r\n\r\n"


def test_foreign_links_and_missing_parts(spark, tmp_path):
    def record(kind, rid, extra="", body=""):
        return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}\r\n{extra}Content-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"

    (tmp_path / "a.warc").write_bytes("".join([
        record("warcinfo", "<i>"), record("request", "<q1>", body="GET"),
        record("response", "<r1>", "WARC-Concurrent-To: <q1>\r\n", "HTTP/1.1 200 OK\r\n\r\nhello"),
        record("metadata", "<m2>", "warc-concurrent-to: <r1>\r\n", "b: 1"), record("metadata", "<m1>", "WARC-Concurrent-To: <r1>\r\n", "a: 1"),
        record("response", "<r2>", body="HTTP/1.1 204 No\r\n\r\n"), record("metadata", "<m3>", "WARC-Concurrent-To: <gone>\r\n"),
    ]).encode())
    rows = {r.id: r for r in assemble(read_records(spark, str(tmp_path))).withColumn("payload", http_payload("body")).collect()}
    assert rows.keys() == {"<r1>", "<r2>"}
    assert rows["<r1>"].request.id == "<q1>" and [m.id for m in rows["<r1>"].metadata] == ["<m1>", "<m2>"]
    assert rows["<r1>"].payload == "hello" and rows["<r2>"].request is None and rows["<r2>"].payload == ""
