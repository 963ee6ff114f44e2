"""Round trips, record by record and through Spark; broken archives."""

import base64
import gzip
import hashlib
import io

import pytest

from rosterworks.llm import warc
from rosterworks.llm.queries import QUERIES, table

ROOT = "/root/testdata/sf0.001"


def test_round_trip(spark):
    pages = {r.page_id: (r.html or "").encode() for r in table(spark, ROOT, "pages").collect()}
    rows = QUERIES["op2_warc"](spark, ROOT).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    for r in rows:
        data = pages[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if first[data] == r.page_id else ("revisit", first[data]))


def test_odd_pages(spark):
    rows = [(5, "u", "same"), (3, None, "same"), (3, None, "same"), (7, "w", None), (2, "z", ""), (None, "q", "same"), (11, "r\r\nX: y", "é" * 300_000), (None, "n", "alone"), (None, "n", "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.page_id, r.url): (r.record_type, r.refers_to, r.payload_bytes) for r in warc.round_trip(pages).collect()}
    assert got[5, "u"] == ("revisit", 3, 4) and got[3, None] == ("response", None, 4) and got[None, "q"] == ("revisit", 3, 4)
    assert got[7, "w"] == ("revisit", 2, 0) and got[11, "r%0D%0AX: y"] == ("response", None, 600_000) and got[None, "n"] == ("response", None, 5)
    assert warc.round_trip(pages).count() == len(rows)
    assert {r.record_type for r in warc.round_trip(pages, revisit_bytes=5).collect() if r.payload_bytes < 5} == {"response"}
    assert warc.round_trip(pages.where("false")).count() == 0


def test_members_and_payloads():
    data = warc.record(1, "http://a/", b"x" * 200_000, None) + warc.record(2, "http://b/", b"x" * 200_000, 1) + warc.record(3, None, b"", None)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 3
    rows = list(warc.read_records(io.BytesIO(data)))
    assert [r["page_id"] for r in rows] == [1, 2, 3] and rows[0]["payload"] == b"x" * 200_000 and rows[1]["payload"] is None
    assert rows[1]["payload_bytes"] == 200_000 and rows[1]["refers_to"] == 1 and rows[2]["payload"] == b""


def test_broken_archives():
    good = warc.record(1, "http://a/", b"payload", None)
    with pytest.raises(ValueError, match="ends inside|shorter"):
        list(warc.read_records(io.BytesIO(good[:-12])))
    changed = gzip.compress(gzip.decompress(good).replace(b"payload\r\n", b"paYload\r\n"))
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(io.BytesIO(changed)))
