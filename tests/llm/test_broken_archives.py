"""Archives with damaged records: what is whole is read, what is not is counted."""

from lodgegrid.llm.warc import broken_records, cut_records, read_records


def record(name, body, size=None, kind="response"):
    size = len(body) if size is None else size
    return (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{name}>\r\nContent-Length: {size}\r\n\r\n{body}"
            "\r\n\r\n").encode()


def test_cut_records():
    a, b = record("a", "one"), record("b", "two WARC/1.1 inside")
    body = lambda r: r[len(b"WARC/1.1\r\n"):-4]
    assert list(cut_records(a + b)) == [(body(a), True), (body(b), True)]
    assert [good for _, good in cut_records(a + b[:25])] == [True, False]  # cut off in a head
    assert [good for _, good in cut_records(a[:-9] + b"")] == [False]  # cut off in a body
    assert [good for _, good in cut_records(record("x", "y", "many") + b)] == [False, True]
    assert [good for _, good in cut_records(b"WARC/1.1")] == [False]
    assert list(cut_records(b"")) == list(cut_records(b"no archive")) == []


def test_whole_records_are_read_and_broken_ones_counted(spark, tmp_path):
    good, tricky = record("a", "one"), record("t", "a line\nWARC/1.1\r\nin the body")
    (tmp_path / "good.warc").write_bytes(good + record("b", "two"))
    (tmp_path / "head.warc").write_bytes(record("c", "three") + tricky + record("d", "four")[:30])
    (tmp_path / "body.warc").write_bytes(record("e", "five") + record("f", "six six six", 200))
    (tmp_path / "length.warc").write_bytes(record("g", "x", "none") + record("h", "eight"))
    found = {r.id: r.body for r in read_records(spark, str(tmp_path)).collect()}
    assert found == {
        "<urn:a>": "one", "<urn:b>": "two", "<urn:c>": "three", "<urn:t>": "a line\nWARC/1.1\r\nin the body",
        "<urn:e>": "five", "<urn:h>": "eight"}
    broken = {r.path.rsplit("/", 1)[1]: r.n_broken for r in broken_records(spark, str(tmp_path)).collect()}
    assert broken == {"head.warc": 1, "body.warc": 1, "length.warc": 1}
