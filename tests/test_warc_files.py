"""WARC files as the page source (S2): files made by hand, and the sink's own read back."""

import gzip

from trawl.sources.pages import split_fetches
from trawl.sources.warc_files import read_fetches, read_records, write_fetches


def record(kind, block, length=None, target="https://h.example/a"):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {target}\r\nwarc-date: 2024-01-01T00:00:00Z\r\n"
    return f"{head}Content-Length: {len(block) if length is None else length}\r\n\r\n".encode() + block + b"\r\n\r\n"


def http(payload, status="200 OK", more="Content-Type: text/html"):
    return f"HTTP/1.1 {status}\r\n{more}\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\n\r\n".encode() + payload


RECORDS = [
    record("warcinfo", b"software: x"),
    record("request", b"GET /a HTTP/1.1\r\n\r\n"),
    record("response", http(b"<p>one\n\r\n\r\ntwo</p>")),
    record("response", http("café".encode("latin-1"), more="content-type: text/html; charset=ISO-8859-1"), target="<https://h.example/b>"),
    record("response", http(b"", "404 Not Found"), target="https://h.example/c"),
    record("response", http(b"bad \xff byte"), target="https://h.example/d"),
    record("response", b"not http", target="https://h.example/e"),
    record("response", http("ü中".encode()), target="https://h.example/f"),
    record("response", http(b"cut"), length=5000, target="https://h.example/g"),
]
WANT = {
    "https://h.example/a": (200, "<p>one\n\r\n\r\ntwo</p>", False),
    "https://h.example/b": (200, "café", False),
    "https://h.example/c": (404, "", False),
    "https://h.example/d": (200, "bad � byte", False),
    "https://h.example/e": (None, "", False),
    "https://h.example/f": (200, "ü中", False),
    "https://h.example/g": (200, None, True),
}


def test_hand_made_files(spark, tmp_path):
    plain, members, whole = tmp_path / "plain", tmp_path / "members", tmp_path / "whole"
    for folder in (plain, members, whole):
        folder.mkdir()
    (plain / "x.warc").write_bytes(b"".join(RECORDS))
    (members / "x.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in RECORDS))
    (whole / "x.warc.gz").write_bytes(gzip.compress(b"".join(RECORDS)))
    for folder in (plain, members, whole):
        rows = read_fetches(spark, str(folder)).collect()
        assert {r.url: (r.status, r.html, r.error is not None) for r in rows} == WANT and len(rows) == len(WANT)
    first = next(r for r in rows if r.url.endswith("/a"))
    assert first.date == "2024-01-01T00:00:00Z"
    assert [h.value for h in first.headers if h.name == "set-cookie"] == ["a=1", "b=2"]
    assert read_records(spark, str(plain)).count() == len(RECORDS)
    pages, errors = split_fetches(read_fetches(spark, str(plain)))
    assert {r.url[-1] for r in pages.collect()} == set("abdf")
    # every response is a page or an error row, one without a readable status too
    assert {r.url[-1] for r in errors.collect()} == set("ceg")


def test_records_are_split_over_tasks_and_none_is_lost(spark, tmp_path):
    folder = tmp_path / "big"
    folder.mkdir()
    (folder / "x.warc").write_bytes(b"".join(record("response", http(b"x" * (i % 977)), target=f"https://h.example/{i}") for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        rows = read_fetches(spark, str(folder))
        assert rows.rdd.getNumPartitions() > 4
        got = {r.url: len(r.html) for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {f"https://h.example/{i}": i % 977 for i in range(3000)}


def test_sink_and_reader(spark, tmp_path):
    rows = [("https://h.example/ü", 200, "<p>\r\n\r\nWARC-Type: response</p>"), ("https://h.example/2", 404, None), ("u\r\nX: 1", 200, "x" * 300_000), (None, 500, ""), ("v", None, "lost")]
    fetched = spark.createDataFrame(rows, "url string, status int, html string")
    for compression in ("gzip", "none"):
        path = str(tmp_path / compression)
        write_fetches(fetched, path, compression)
        got = {(r.url, r.status, r.html, r.error) for r in read_fetches(spark, path).collect()}
        assert got == {(rows[0][0], 200, rows[0][2], None), (rows[1][0], 404, "", None), ("u%0D%0AX: 1", 200, rows[2][2], None), ("", 500, "", None)}
    write_fetches(fetched.limit(0), str(tmp_path / "none_at_all"))
    assert read_fetches(spark, str(tmp_path / "none_at_all")).count() == 0
