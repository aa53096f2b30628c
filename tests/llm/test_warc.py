"""Archives written and read back."""

import gzip
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import warc

PAGES = [
    (3, "http://a/x", "<p>one</p>"), (1, "http://b/ y\r\nEvil: 1", "<p>one</p>"), (2, None, None), (4, "", ""),
    (5, "http://ü/", "é" * 50_000), (6, "u", "\r\n\r\n\x00"), (None, "n", "<p>one</p>"), (None, "n", "only null"),
    (7, "r", "twice"), (7, "r", "twice"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload_digest string")


def test_records_come_back_as_they_went_in(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(pages(spark), path)
    back = warc.read_archives(spark, path).collect()
    assert len(back) == len(PAGES)
    by_id = {}
    for row in back:
        by_id.setdefault(row["record_id"].removeprefix("urn:page:"), []).append(row)
    for page_id, url, html in PAGES:
        if page_id is None:
            continue
        row = by_id[str(page_id)][0]
        data = (html or "").encode()
        assert row["payload_bytes"] == len(data) and row["payload_digest"] == warc.sha1_base32(data)
        if row["record_type"] == "response":
            assert bytes(row["payload"]) == data and row["refers_to"] is None
    assert [by_id[i][0]["record_type"] for i in "1324"] == ["response", "revisit", "response", "revisit"]
    assert by_id["3"][0]["refers_to"] == "urn:page:1" and by_id["4"][0]["refers_to"] == "urn:page:2"
    assert [r["record_type"] for r in by_id["7"]] == ["response", "response"]
    assert sorted(r["record_type"] for r in by_id[""]) == ["response", "revisit"]


def test_small_payloads_can_be_left_alone(spark):
    roles = {r["page_id"]: r["record_type"] for r in warc.with_roles(pages(spark), 5).where("page_id < 5").collect()}
    assert roles == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_files_are_gzip_and_one_member_for_each_record(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(pages(spark), path)
    data = b"".join((tmp_path / "w" / f).read_bytes() for f in sorted(os.listdir(path)) if f.startswith("part"))
    assert data.count(b"\x1f\x8b\x08") >= len(PAGES)
    whole = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
    assert whole.count(b"WARC/1.1\r\n") == len(PAGES) and b"\nEvil: 1" not in whole


def test_long_members_keep_their_length_field():
    random.seed(1)
    for size in (0, 100, (1 << 24) - 300, (1 << 24) + 10):
        member = warc.record(1, "u", b"a" * size, size, warc.sha1_base32(b"a" * size), None, "response")
        stored = warc.without_end(member) + b"\0"
        found = list(warc.records(stored * 2))
        assert len(found) == 2 and all(len(r["payload"]) == size for r in found)


def test_damage_is_an_error():
    digest = warc.sha1_base32(b"data")
    good = warc.record(1, "u", b"data", 4, digest, None, "response")
    with pytest.raises(warc.BadRecord, match="ends within"):
        list(warc.records(good[:-12]))
    with pytest.raises(warc.BadRecord, match="payload"):
        list(warc.records(warc.record(1, "u", b"DATA", 4, digest, None, "response")))
    plain = gzip.decompress(good).replace(b"data", b"date")
    with pytest.raises(warc.BadRecord, match="block"):
        list(warc.records(gzip.compress(plain)))
    with pytest.raises(warc.BadRecord, match="as long"):
        list(warc.records(gzip.compress(plain[:-1])))


def test_digest_in_base32(spark):
    row = spark.range(1).select(warc.base32(F.sha1(F.lit(b"abc"))).alias("d")).first()
    assert row["d"] == warc.sha1_base32(b"abc")


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(pages(spark).limit(0), path)
    assert warc.read_archives(spark, path).count() == 0


def foreign(kind, block, *lines, content="application/http; msgtype=response"):
    head = [f"WARC-Type: {kind}", f"Content-Type: {content}", f"Content-Length: {len(block)}", *lines]
    return gzip.compress("\r\n".join(["WARC/1.0", *head]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def test_archives_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n"
    chunks = b"4\r\ndata\r\n0\r\n\r\n"
    members = [
        foreign("warcinfo", b"software: x\r\n", "WARC-Record-ID: <urn:a>", content="application/warc-fields"),
        foreign("request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n", content="application/http; msgtype=request"),
        foreign("response", http + b"\r\nbody", "WARC-Target-URI: http://h/"),
        foreign("response", http + b"Content-Length: 4\r\n\r\nbody", "WARC-Payload-Digest: sha256:00"),
        foreign("response", http + b"Transfer-Encoding: chunked\r\n\r\n" + chunks, "WARC-Payload-Digest: sha1:" + warc.sha1_base32(b"data")),
        foreign("response", http + b"Content-Length: 9\r\n\r\nbody", "WARC-Truncated: length"),
        foreign("response", b"h. 300 IN A 1.2.3.4", content="text/dns"),
        foreign("resource", b"\xff\r\n\r\n\x00", "WARC-Payload-Digest: sha1:" + warc.sha1_base32(b"\xff\r\n\r\n\x00"), content="image/x"),
        foreign("revisit", http + b"\r\n", "WARC-Refers-To: <urn:b>"),
        foreign("response", http + b"X-\xff: \xe9\r\n\r\nbody"),
    ]
    (tmp_path / "crawl-1.warc.gz").write_bytes(b"".join(members))
    got = warc.read_archives(spark, str(tmp_path), names="*.warc.gz").collect()
    assert [(r["record_type"], r["payload"] and bytes(r["payload"]), r["payload_bytes"]) for r in got] == [
        ("warcinfo", b"software: x\r\n", 13), ("request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n", 27), ("response", b"body", 4),
        ("response", b"body", 4), ("response", chunks, len(chunks)), ("response", b"body", 4),
        ("response", b"h. 300 IN A 1.2.3.4", 19), ("resource", b"\xff\r\n\r\n\x00", 6), ("revisit", None, None), ("response", b"body", 4),
    ]
    assert [got[i]["record_id"] for i in (0, 1)] == ["urn:a", None] and got[8]["refers_to"] == "urn:b"
    assert got[2]["payload_digest"] is None and got[3]["payload_digest"] == "sha256:00"
    for bad, reason in (
        (foreign("resource", b"x", "WARC-Payload-Digest: sha1:" + "A" * 32, content="a/b"), "payload"),
        (foreign("response", http + b"Content-Length: 9\r\n\r\nbody"), "payload"),
        (gzip.compress(b"WARC/1.0\r\nWARC-Type: x\r\n\r\n"), "how long"),
        (gzip.compress(b"WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n"), "no type"),
    ):
        with pytest.raises(warc.BadRecord, match=reason):
            list(warc.records(bad))
