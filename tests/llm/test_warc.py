"""WARC round trips: digests, roles, segments and separators inside payloads."""

import base64
import gzip
import glob
import hashlib

from folio.llm import common, warc

ODD = [
    (1, "http://a/x y\r\nz", "", "k"), (2, None, None, "k"), (3, "u", "a\r\n\r\nb\r\n\r\n", "k"), (4, "u", "\r\n\r\n", "k"), (5, "u", "x" * 5000, "k"), (6, "u", "x" * 5000, "k"),
    (7, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n", "k"), (8, "u", "é" * 999 + "\r\n", "k"), (9, "u", "é" * 999 + "\r\n", "k"), (9, "u", "é" * 999 + "\r\n", "k"), (None, "u", "null id", "k"), (10, "u", "null id", "k"), (11, "u", "\n" * 40, "k"),
]


def expected(rows):
    first = {}
    for i, _, h, _ in rows:
        k = h or ""
        if i is not None:
            first[k] = min(first.get(k, i), i)
    for i, _, h, _ in rows:
        b = (h or "").encode()
        own = first.get(h or "") == i
        yield i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if own else "revisit", None if own else first.get(h or "")


def test_round_trip(spark):
    df = spark.createDataFrame(ODD, "page_id long, url string, html string, record_type string")
    key = lambda r: tuple(str(x) for x in r)
    for size in (7, 1000, 1 << 20):
        got = warc.digest_query(df, segment_bytes=size).collect()
        assert all(r.intact for r in got)
        assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(expected(ODD), key=key)
    small = warc.digest_query(df, min_bytes=5000).collect()
    assert [r.page_id for r in small if r.record_type == "revisit"] == [6]
    assert warc.digest_query(df.limit(0)).collect() == []
    # One identifier, two payloads: a revisit is resolved to that of its digest.
    twice = spark.createDataFrame([(5, "u", "A", "k"), (5, "u", "B", "k"), (6, "u", "A", "k"), (7, "u", "B", "k")], df.schema)
    assert sorted(tuple(r)[:3] for r in warc.digest_query(twice).collect()) == sorted(tuple(e)[:3] for e in expected([tuple(r) for r in twice.collect()]))


def test_revisit_without_response_is_not_intact(spark, monkeypatch):
    df = spark.createDataFrame([(1, "u", "same"), (2, "u", "same")], "page_id long, url string, html string")
    whole = warc.round_trip
    monkeypatch.setattr(warc, "round_trip", lambda *a, **k: whole(*a, **k).where("record_type = 'revisit'"))
    (r,) = warc.digest_query(df).collect()
    assert (r.page_id, r.payload_bytes, r.payload_digest, r.intact) == (2, None, None, False)


def test_files_and_chunks(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", b"abc" * 1000), (2, "u", b"\x00\xff\r\n\r\n\x80")], "record_key long, target_uri string, payload binary")
    to = warc.write(warc.archive_rows(warc.with_roles(df), segment_bytes=700), str(tmp_path / "w"))
    raw = b"".join(gzip.open(f).read() for f in glob.glob(f"{to}/*.gz"))
    assert raw.count(b"WARC/1.1\r\n") == 6 and raw.endswith(b"\r\n\r\n")
    rows = sorted(warc.read(spark, to, data=True).collect(), key=lambda r: (r.record_id, r.chunk_no))
    one = [r for r in rows if r.record_id == "urn:page:1"]
    assert [r.n_bytes for r in one] == [700, 1400, 2100, 2800, 3000] and b"".join(r.data for r in one) == b"abc" * 1000
    for r in one:
        assert r.digest == base64.b32encode(hashlib.sha1((b"abc" * 1000)[: r.n_bytes]).digest()).decode()
    assert b"".join(r.data for r in rows if r.record_id == "urn:page:2") == b"\x00\xff\r\n\r\n\x80"


def test_segments_stay_in_one_file(spark):
    df = spark.createDataFrame([(1, "u", "x" * 100_001, "k")], "page_id long, url string, html string, record_type string")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "1000")
    try:
        got = warc.digest_query(df, segment_bytes=1).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert [tuple(r)[:2] for r in got] == [(1, 100_001)] and got[0].intact
