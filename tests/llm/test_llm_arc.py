from __future__ import annotations

import gzip
import hashlib
import io
from collections import defaultdict

import pytest

from millrace.llm.arc import _iso, _warc_record, convert, parse_arc, parse_warc, read_arc, revisits, split_http, write_arc

PAGES = "page_id long, url string, html string, record_id string, payload_bytes int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], PAGES).repartition(3)


LONG = "<p>" + "é long payload " * 20
ROWS = [
    (1, "http://a.example/x", LONG),
    (2, "http://b.example/a b\nc", LONG),
    (3, None, "short"),
    (4, "", "short"),
    (5, "http://a.example/é", None),
    (6, "http://a.example/", ""),
    (7, "http://a.example/", "WARC/1.1\r\n\r\n\r\n\r\nContent-Length: 9\n\nhttp://x 0.0.0.0 20000101000000 text/html 3\nabc" * 3),
    (8, "http://c.example/", "big " * 300_000),
    (9, "http://c.example/", "big " * 300_000),
    (9, "http://c.example/", "big " * 300_000),
    (None, "http://c.example/", LONG),
    (0, "http://z.example/", LONG + " not equal"),
]


def test_odd_rows(spark):
    found = convert(pages(spark, ROWS)).collect()
    assert len(found) == len(ROWS)
    groups = defaultdict(list)
    for i, _, h in ROWS:
        groups[h or ""].append(i)
    kinds = defaultdict(list)
    for r in found:
        kinds[r.payload_digest].append(r)
    assert len({r.record_id for r in found}) == len(ROWS)
    for text, ids in groups.items():
        data = text.encode()
        rows = kinds[hashlib.sha256(data).hexdigest()]
        assert sorted(map(str, (r.page_id for r in rows))) == sorted(map(str, ids))
        assert {r.payload_bytes for r in rows} == {len(data)} and all(r.declared_digest == r.payload_digest for r in rows)
        heads = [r for r in rows if r.record_type == "response"]
        if len(data) < 100:
            assert len(heads) == len(rows)
        else:
            assert len(heads) == 1 and heads[0].page_id == min(i for i in ids if i is not None)
            assert all(r.refers_to == heads[0].page_id for r in rows if r.record_type == "revisit")


def test_no_pages(spark):
    assert convert(pages(spark, [])).collect() == []


def test_reruns_agree(spark):
    docs = pages(spark, ROWS).coalesce(2)
    assert sorted(map(str, convert(docs).collect())) == sorted(map(str, convert(docs).collect()))


def test_both_versions_are_written(spark, tmp_path):
    write_arc(pages(spark, ROWS), str(tmp_path / "arc"))
    heads = set()
    for file in (tmp_path / "arc").glob("part-*"):
        heads.add(gzip.decompress(file.read_bytes()).split(b"\n")[1][:1])
    assert heads == {b"1", b"2"}
    rows = read_arc(spark, str(tmp_path / "arc"))
    assert {r.url for r in rows.collect()} >= {"http://b.example/a%20b%0Ac", "urn:none", "http://a.example/%C3%A9"}
    assert revisits(rows).count() == 4


def archive(version: int, name: str, records: list[tuple[str, bytes]], tail: bytes = b"") -> bytes:
    """Records under a version block; their headers lack the length, which is added."""
    fields = {1: "URL IP-address Archive-date Content-type Archive-length"}
    fields[2] = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
    block = f"{version} 0 Somebody\n{fields[version]}\n\n".encode()
    middle = f" 200 - - 0 {name}" if version == 2 else ""
    out = f"filedesc://{name} 0.0.0.0 19960923142103 text/plain{middle} {len(block)}\n".encode() + block + b"\n"
    for head, body in records:
        out += f"{head} {len(body)}\n".encode() + body + b"\n"
    return out + tail


def test_version_1_by_hand():
    page = b"HTTP/1.0 200 OK\nServer: x\n\n<html>first</html>\n"
    records = [
        ("http://www.example.com:80/a b 192.0.2.1 19961104142103 text/html", page),
        ("http://www.example.com/t.txt 192.0.2.1 199611040000 text/plain", b"plain"),
    ]
    tail = b"this line is no header\nhttp://www.example.com/cut 192.0.2.1 19961104142104 text/html 500\nHTTP/1.0 200 OK\r\n\r\ncut"
    found = list(parse_arc(io.BytesIO(archive(1, "old.arc", records, tail)), "?"))
    assert [r.url for r in found] == ["http://www.example.com:80/a b", "http://www.example.com/t.txt", "http://www.example.com/cut"]
    assert split_http(found[0].body) == (b"HTTP/1.0 200 OK\nServer: x\n\n", b"<html>first</html>\n")
    assert split_http(found[1].body) is None and found[1].body == b"plain"
    assert [r.truncated for r in found] == [False, False, True] and {r.archive for r in found} == {"old.arc"}
    assert [_iso(r.date) for r in found] == ["1996-11-04T14:21:03Z", "1996-11-04T00:00:00Z", "1996-11-04T14:21:04Z"]


def test_version_2_by_hand():
    body = b"HTTP/1.0 200 OK\r\n\r\nhello"
    text = archive(2, "new.arc", [("http://www.example.com/ 192.0.2.7 19970101120000 text/html 200 abc - 300 new.arc", body)])
    (only,) = parse_arc(io.BytesIO(text), "?")
    assert (only.url, only.ip, only.kind) == ("http://www.example.com/", "192.0.2.7", "text/html")
    assert split_http(only.body) == (b"HTTP/1.0 200 OK\r\n\r\n", b"hello")


@pytest.mark.parametrize("block", [b"", b"\r\n\r\nWARC/1.1\r\n", b"x" * 70_000])
def test_warc_records_by_declared_length(block):
    one = _warc_record([("WARC-Type", "resource"), ("WARC-Record-ID", "<urn:x>")], block)
    stream = io.BufferedReader(io.BytesIO(one + b"\r\n\r\n" + one + b"\r\n\r\n"))
    assert [(f["warc-record-id"], b) for f, b in parse_warc(stream)] == [("<urn:x>", block)] * 2
