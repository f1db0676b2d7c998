import base64
import hashlib

import pytest

from telemere.llm import arc
from tests.llm.data import plain

SCHEMA = "page_id long, url string, html string, digest string, position int"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], SCHEMA)


ROWS = [
    (1, "http://a.example/1", "<p>same</p>"),
    (2, "http://a.example/2 with space", "<p>same</p>"),
    (3, None, None),
    (4, "", ""),
    (5, "http://b.example/", "WARC/1.1\r\n\r\nhttp://x 1.1.1.1 20200101000000 text/html 5\n漢字 \r\n\n"),
    (6, "http://b.example/", "x" * 300_000),
    (None, "http://c.example/", "<p>same</p>"),
    (7, "http://d.example/", "<p>twice</p>"),
    (7, "http://d.example/", "<p>twice</p>"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows):
    out = []
    for text in {t or "" for _, _, t in rows}:
        ids = sorted((i for i, _, t in rows if (t or "") == text), key=lambda i: (i is not None, i))
        size = len(text.encode())
        out += [(ids[-1], size, digest(text), "response", None)]
        out += [(i, size, digest(text), "revisit", ids[-1]) for i in ids[:-1]]
    return sorted(out, key=str)


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip(spark, version):
    result = sorted(plain(arc.round_trip(table(spark, ROWS), version)), key=str)
    assert result == expected(ROWS)


def test_a_payload_that_most_pages_share(spark):
    rows = [(i, f"http://e.example/{i}", "shared" if i % 3 else f"own {i}") for i in range(3000)]
    assert sorted(plain(arc.round_trip(table(spark, rows))), key=str) == expected(rows)


def test_small_payloads_are_responses(spark):
    rows = [(1, "u:1", "ab"), (2, "u:2", "ab"), (3, "u:3", "long enough"), (4, "u:4", "long enough")]
    result = {r.page_id: r.record_type for r in arc.round_trip(table(spark, rows), least=5).collect()}
    assert result == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_empty_table(spark):
    assert plain(arc.round_trip(table(spark, []))) == []


@pytest.mark.parametrize("version", [1, 2])
def test_headers_follow_the_version(version):
    data = arc._arc_head("name", "20240101000000", version).encode() + arc.arc_record(9, "http://x/", "hi", version)
    ((_, fields, block),) = arc.parse_arc(data)
    assert fields["URL"] == "http://x/" and len(block) == int(fields["Archive-length"]) and block.endswith(b"hi")
    assert len(fields) == (5 if version == 1 else 10)


def test_broken_archives_fail():
    head = arc._arc_head("name", "20240101000000", 1).encode()
    with pytest.raises(ValueError, match="past the end"):
        list(arc.parse_arc(head + b"http://x/ 1.1.1.1 20240101000000 text/html 50\nshort\n"))
    with pytest.raises(ValueError, match="fields"):
        list(arc.parse_arc(head + b"http://x/ 20240101000000 5\nshort\n"))
    with pytest.raises(ValueError, match="version block"):
        list(arc.parse_arc(b"http://x/ 1.1.1.1 20240101000000 text/html 5\nshort\n"))


def test_records_convert_to_equivalent_fields():
    record = {
        "record_type": "response", "uri": "http://x/", "date": "20240102030405", "digest": digest("hi"), "page_id": 1,
        "ip": "1.2.3.4", "head": b"HTTP/1.1 200 OK\r\n\r\n", "payload": b"hi", "mime": "text/html", "payload_bytes": 2,
    }
    ((fields, block),) = arc.parse_warc(arc.warc_record(record))
    assert fields["warc-date"] == "2024-01-02T03:04:05Z" and fields["warc-type"] == "response"
    assert fields["warc-payload-digest"] == "sha1:" + digest("hi") and block.endswith(b"\r\n\r\nhi")
    assert fields["warc-record-id"].startswith("<urn:uuid:")
