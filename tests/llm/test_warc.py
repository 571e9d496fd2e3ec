"""The archive converter."""

from __future__ import annotations

import gzip
import hashlib
import os

import pytest

from pricewright.llm import warc

PAGES = "page_id long, url string, html string"


def convert(spark, rows, tmp_path):
    pages = spark.createDataFrame(rows, PAGES)
    arc, out = str(tmp_path / "arc"), str(tmp_path / "warc")
    warc.write_archives(warc.arc_of_pages(pages), arc, b"\n")
    warc.convert(spark, arc, out)
    return warc.read_warc(spark, out), arc, out


def files(path):
    for name in sorted(os.listdir(path)):
        if name.startswith("part"):
            with gzip.open(f"{path}/{name}") as f:
                yield f.read()


def test_registered_query(spark):
    rows = warc.op8_warc(spark, "/root/testdata/sf0.001").collect()
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    first = {}
    for p in sorted(pages, key=lambda p: p.page_id):
        first.setdefault(p.html, p.page_id)
    expected = []
    for p in pages:
        b = (p.html or "").encode()
        lead = first[p.html] if len(b) >= 100 else p.page_id
        kind = "response" if lead == p.page_id else "revisit"
        expected.append(
            (p.page_id, len(b), hashlib.sha256(b).hexdigest(), kind, None if kind == "response" else lead)
        )
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_revisits_and_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 4000)
    page = "<html>\r\n\r\nWARC/1.1 filedesc://x é" + "y" * 100
    rows = [
        (5, "http://a/ b", page), (3, "http://a/c", page), (9, None, page), (9, None, page),
        (4, "http://s", "short"), (6, "http://s", "short"), (7, "http://n", None), (8, "", ""),
        (None, "http://null", "z" * 200), (1, "http://z", "z" * 200),
        (20, "http://long", "w " * 20_000),
    ]
    found, arc, out = convert(spark, rows, tmp_path)
    got = [r for r in found.collect() if r.record_type in ("response", "revisit")]
    assert len(got) == len(rows) and len(list(files(out))) > 1
    versions = {content.split(b"\n")[1][:1] for content in files(arc)}
    assert versions <= {b"1", b"2"} and versions
    ids = {r.record_id: r.page_id for r in got if r.record_type == "response"}
    kinds = {}
    for r in got:
        kinds.setdefault(r.page_id, set()).add((r.record_type, ids.get(r.refers_id, "-")))
        text = next(h for p, _, h in rows if p == r.page_id) or ""
        assert r.payload_bytes == len(text.encode())
        assert r.payload_digest == hashlib.sha256(text.encode()).hexdigest()
    assert kinds[3] == {("response", "-")} and kinds[5] == kinds[9] == {("revisit", 3)}
    assert kinds[4] == kinds[6] == kinds[7] == kinds[8] == {("response", "-")}
    assert kinds[None] == {("response", "-")} and kinds[1] == {("revisit", None)}
    for content in files(out):
        assert content.startswith(b"WARC/1.1\r\n") and content.endswith(b"\r\n\r\n")


def test_empty_table(spark, tmp_path):
    found, _, _ = convert(spark, [], tmp_path)
    assert found.filter("record_type <> 'warcinfo'").count() == 0


V1 = (
    b"filedesc://old.arc 0.0.0.0 19960923142103 text/plain 76\n"
    b"1 0 Alexa Internet\nURL IP-address Archive-date Content-type Archive-length\n\n"
)


def test_version_1_record():
    block = b"HTTP/1.0 200 OK\r\n\r\nhello"
    content = V1 + b"\nhttp://a b/ 10.0.0.1 19961104142103 text/html %d\n" % len(block) + block
    head, record = warc.parse_arc(content)
    assert (record.url, record.ip, record.block) == ("http://a b/", "10.0.0.1", block)
    assert warc.iso_date(record.date) == "1996-11-04T14:21:03Z" and not record.cut
    assert warc._warc_fields(head)[1] == "warcinfo"
    assert warc._warc_fields(record)[8:11] == (b"hello", hashlib.sha256(b"hello").hexdigest(), 5)


def test_version_2_record_and_damage():
    body = b"2 0 pages\n" + " ".join(warc.ARC_FIELDS[2]).encode() + b"\n"
    content = b"filedesc://new.arc 0.0.0.0 20010101000000 text/plain %d\n" % len(body) + body
    content += b"\nthis line is damaged\n"
    content += b"\ndns:x 10.0.0.2 20010202 text/dns 200 - - 99 new.arc 3\nabc"
    content += b"\nhttp://cut 10.0.0.3 2001 text/html 200 - - 99 new.arc 50\nHTTP/1.0"
    _, dns, cut = warc.parse_arc(content)
    assert (dns.url, dns.block, warc._warc_fields(dns)[1]) == ("dns:x", b"abc", "resource")
    assert warc.iso_date(dns.date) == "2001-02-02T00:00:00Z"
    assert cut.cut and cut.block == b"HTTP/1.0" and warc.iso_date(cut.date) == "2001-01-01T00:00:00Z"


def test_damaged_warc_is_an_error():
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.parse_warc(b"WARK/1.1\r\n\r\n"))
