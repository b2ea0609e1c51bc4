import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from quayside.llm import warc

BIG = "é<html>" + "x" * 3000


def rows_of(spark, scratch, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn("size", F.lit(1))
    archives = warc.write(pages.repartition(3), scratch.path("warc"), scratch, **options)
    return archives, warc.read(archives).collect()


def test_round_trip(spark, scratch):
    rows = [(1, "http://a/ü?x=1", BIG), (2, "http://b\r\nInjected: 1", BIG), (3, None, "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (None, "u", BIG), (7, "u", "z" * 1000), (7, "u", "z" * 1000)]
    archives, got = rows_of(spark, scratch, rows)
    found = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got)
    expected = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = html == BIG and i != 2
        expected.append((i or 0, "revisit" if again else "response", 2 if again else None, len(data), hashlib.sha1(data).hexdigest()))
    assert found == sorted(expected) and all(r["error"] is None for r in got)
    assert archives.agg(F.sum("records")).first()[0] == len(rows)


def test_members_are_plain_gzip(spark, scratch):
    archives, _ = rows_of(spark, scratch, [(1, "u", "a"), (2, "u", "b" * 5000)])
    for row in archives.collect():
        from quayside.llm.files import opened

        fs, path = opened(row["path"])
        with fs.open_input_stream(path, compression=None) as f:
            text = gzip.decompress(f.read())
        assert text.count(b"WARC/1.1\r\n") == row["records"] and text.endswith(b"\r\n\r\n")


def test_damage_is_told():
    good = warc.record(1, "u", b"p" * 2000, hashlib.sha1(b"p" * 2000).hexdigest(), None, False)
    assert next(warc.records(io.BytesIO(good)))["error"] is None
    wrong = warc.record(1, "u", b"p" * 2000, "0" * 40, None, False)
    assert next(warc.records(io.BytesIO(wrong)))["error"] == "payload digest"
    two = list(warc.records(io.BytesIO(good + good)))
    assert len(two) == 2
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good + good[:-20])))
    text = gzip.decompress(good)
    for cut in (text[:-4] + b"xx\r\n\r\n", text[:-10], text[:-2], text.replace(b"WARC/1.1", b"WARC/9.9")):
        with pytest.raises((ValueError, KeyError)):
            list(warc.records(io.BytesIO(gzip.compress(cut))))


def test_a_record_needs_little_memory():
    """A large payload is read in chunks."""
    import tracemalloc

    payload = bytes(40_000_000)
    member = warc.record(1, "u", payload, hashlib.sha1(payload).hexdigest(), None, False)
    tracemalloc.start()
    assert next(warc.records(io.BytesIO(member)))["payload_bytes"] == len(payload)
    assert tracemalloc.get_traced_memory()[1] < 2_000_000
    tracemalloc.stop()


def test_a_very_long_url_between_others(spark, scratch):
    pages = spark.createDataFrame([(1, "u", "one"), (2, "é" * 600_000, "two"), (3, "v", "three")], "page_id long, url string, html string").coalesce(1)
    archives = warc.write(pages, scratch.path("long"), scratch)
    got = sorted((r["page_id"], r["payload_bytes"], r["error"]) for r in warc.read(archives).collect())
    assert archives.count() == 1 and got == [(1, 3, None), (2, 3, None), (3, 5, None)]


def test_a_full_archive_is_followed_by_another(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    pages = spark.range(40).selectExpr("id AS page_id", "'u' AS url", "concat('page ', id) AS html").coalesce(1)
    archives = warc.write(pages, scratch.path("rolled"), scratch)
    got = warc.read(archives).collect()
    assert archives.count() > 3 and sorted(r["page_id"] for r in got) == list(range(40)) and all(r["error"] is None for r in got)


def test_archives_roll_over_and_empty_tables(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 300)
    member = [warc.record(i, "u", b"x", "0" * 40, None, False) for i in range(3)]
    assert all(len(m) > 150 for m in member)
    _, got = rows_of(spark, scratch, [])
    assert got == []
