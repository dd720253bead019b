import base64
import gzip
import hashlib
import tempfile

import pytest

from kestrel.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, refers_to string, path string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "q", "r") for r in rows], SCHEMA)


ROWS = [(1, "http://a/1", "<p>same</p>"), (7, "http://a/7", "<p>same</p>"), (3, None, "<p>same</p>"),
        (4, "http://b\r\nX: y", None), (5, "é", ""), (6, "http://c", "z" * 400_000), (None, "u", "<p>only</p>"),
        (8, "r", "<p>twice</p>"), (8, "r", "<p>twice</p>"), (9, "e", "WARC/1.1\r\n\r\n\x1f\x8b\x00é漢")]


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "PIECE", 37)
    got = sorted(warc.round_trip(frame(spark, ROWS)).collect(), key=lambda r: (r["page_id"] or 0, r["url"] or ""))
    assert len(got) == len(ROWS)
    payload = {i: (h or "").encode() for i, _, h in ROWS}
    for r in got:
        p = payload[r["page_id"]]
        assert r["payload_bytes"] == len(p)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(p).digest()).decode()
    kind = [(r["page_id"], r["record_type"], r["refers_to"]) for r in got]
    assert kind == [(None, "response", None), (1, "revisit", 7), (3, "revisit", 7), (4, "revisit", 5),
                    (5, "response", None), (6, "response", None), (7, "response", None), (8, "response", None),
                    (8, "response", None), (9, "response", None)]


def test_small_payloads_stay_responses(spark):
    got = warc.round_trip(frame(spark, ROWS), least=1).collect()
    assert {r["record_type"] for r in got if r["page_id"] in (4, 5)} == {"response"}


def test_files_are_gzip_members_and_roll_over(spark, monkeypatch):
    folder = tempfile.mkdtemp()
    monkeypatch.setattr(warc, "ROLL", 300)
    d = frame(spark, ROWS).coalesce(1)
    manifest = warc.write_archives(warc.plan_records(d).coalesce(1), folder)
    files = manifest.collect()
    assert sum(f["records"] for f in files) == len(ROWS)
    text = b"".join(gzip.open(f["path"]).read() for f in files)
    assert text.count(b"WARC/1.1\r\nWARC-Type") == len(ROWS)
    back = warc.read_archives(manifest, folder, payload=True).collect()
    assert {bytes(r["payload"]) for r in back if r["record_type"] == "response"} >= {("z" * 400_000).encode(), b""}


def one(data: bytes):
    return [warc.parse(*warc.read_record(m)) for m in warc.members(iter([data[:50], data[50:]]))]


def test_broken_archives_are_found():
    good = warc.record(1, "u", b"payload", None)
    assert one(good)[0]["payload"] == b"payload" and len(one(good + good)) == 2
    plain = gzip.decompress(good)
    for bad in (plain.replace(b"payload", b"Payload"), plain.replace(b"Content-Length: 7", b"Content-Length: 8"),
                plain[:-2], plain.replace(b"WARC/1.1", b"HTTP/1.1")):
        with pytest.raises(ValueError):
            one(gzip.compress(bad))
    with pytest.raises(ValueError):
        one(good[:-3])


def test_empty_table(spark):
    assert warc.round_trip(frame(spark, [])).count() == 0


def test_real_pages(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r for r in warc.round_trip(d).collect()}
    assert all(got[r["page_id"]]["payload_bytes"] == len((r["html"] or "").encode()) for r in d.collect())
