from __future__ import annotations

import gzip
import hashlib

import pytest

from shelfcast.llm import warc
from shelfcast.llm.store import fresh_path
from shelfcast.llm.warc import joined_revisits, read_archives, read_pages, records_of, write_archives

BIG, BIG2 = "<p>WARC/1.1\r\n\r\n" + "é漢🙂" * 60 + "\r\n\r\n", "\x00\r\n" * 70
PAGES = [
    (5, "http://a/5", BIG), (3, "http://a/3", BIG), (9, None, BIG), (None, "http://a/n", BIG), (3, "http://a/3", BIG), (7, "u\r\nv %0A", BIG2), (8, "", BIG2),
    (1, "http://a/1", "small"), (2, "http://a/2", "small"), (4, "http://a/4", None), (6, "http://a/6", ""), (None, None, None), (-12, "x", "y" * 99), (-13, "x", "y" * 99),
    (-14, "x", "z" * 100), (-15, "x", "z" * 100), (20, "long", "w" * 3_000_000), (21, "long", "w" * 3_000_000), (22, "http://b", "alone " * 50),
]


def wanted(pages, least=100):
    low = {}
    for i, _, html in pages:
        if i is not None and len((html or "").encode()) >= least:
            low[html] = min(i, low.get(html, i))
    out = []
    for i, url, html in pages:
        raw = (html or "").encode()
        again = html in low and i != low[html]
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", low[html] if again else None, html or ""))
    return sorted(out, key=repr)


def test_round_trip(spark):
    pages = spark.createDataFrame([(*p, "clash", 1) for p in PAGES], "page_id bigint, url string, html string, digest string, salt int").repartition(5)
    path = fresh_path(spark, "test-archives")
    write_archives(pages, path, per_archive=3)
    got = read_pages(spark, path)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.select(*columns, "html").collect()), key=repr) == wanted(PAGES)
    assert sorted((tuple(r) for r in read_pages(spark, path, html=False).select(*columns).collect()), key=repr) == [r[:-1] for r in wanted(PAGES)]
    urls = {r["page_id"]: r["url"] for r in got.collect()}
    assert urls[5] == "http://a/5" and urls[9] is None and urls[7] == "u%0D%0Av %0A" and urls[8] == ""
    raw = read_archives(spark, path)
    assert raw.where("record_type = 'revisit'").count() == 6 and raw.where("record_type = 'revisit' and payload is not null").count() == 0
    assert raw.where("payload_bytes > 2000000").count() == 1
    assert {r["date"] for r in raw.collect()} == {"2024-01-01T00:00:00Z"}
    assert joined_revisits(raw, payload=True).where("payload is null").count() == 0


def test_text_ids_and_other_settings(spark):
    pages = spark.createDataFrame([("b>/ü", "u", "same " * 30), ("a b", "u", "same " * 30), ("c", "u", "k")], "page_id string, url string, html string")
    path = fresh_path(spark, "test-archives")
    write_archives(pages, path, least=1)
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in read_pages(spark, path, "string").collect()}
    assert got == {"b>/ü": ("revisit", "a b"), "a b": ("response", None), "c": ("response", None)}


def test_empty(spark):
    path = fresh_path(spark, "test-archives")
    write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), path)
    assert read_pages(spark, path).count() == 0


def record(payload: bytes, kind: str = "resource") -> bytes:
    return b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (kind.encode(), len(payload), payload)


@pytest.mark.parametrize("chunk", [1, 2, 5, 64, 1 << 20])
def test_members_and_chunks(monkeypatch, chunk):
    monkeypatch.setattr(warc, "CHUNK", chunk)
    payloads = [b"", b"a", b"\r\n\r\n", b"WARC/1.0\r\n\r\n" * 9, b"x" * 1000]
    for archive in (b"".join(map(record, payloads)), b"".join(gzip.compress(record(p)) for p in payloads), gzip.compress(b"".join(map(record, payloads)))):
        assert [r.payload for r in records_of(archive)] == payloads
    assert list(records_of(b"")) == []


def test_damaged():
    whole = record(b"abc")
    for archive in (whole[:-1], whole[:20], whole + b"x", gzip.compress(whole)[:-9], whole.replace(b": 3", b": 2"), b"HTTP/1.1 200 OK\r\n\r\n"):
        with pytest.raises(ValueError):
            list(records_of(archive))


def test_digest_is_checked(spark):
    path = fresh_path(spark, "test-archives")
    text = "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 1\r\n\r\na\r\n\r\n"
    spark.createDataFrame([(text.encode().decode(),)], "value string").write.option("lineSep", "\n").text(path)
    with pytest.raises(Exception, match="not the one of its digest|the archive ends"):
        read_archives(spark, path).collect()
