import hashlib

import pytest
from pyspark.sql import functions as F

from llm.helpers import ordered
from starbi.llm import warc

BIG = "é" * 600
PAGES = [(1, "http://a/", BIG), (2, "http://b/", BIG), (3, None, BIG), (4, "http://c/\r\nX: y", "small"),
         (5, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", "x" * 999), (9, "u", "x" * 999),
         (10, "u", "y" * 1000), (11, "u", "y" * 1000), (11, "u", "y" * 1000), (None, "u", BIG),
         (None, "u", "z" * 2000), (None, "u", "z" * 2000), (12, "u", "one\r\n\r\nWARC-Type: revisit\r\n")]
SCHEMA = "page_id long, url string, html string"


def brute(pages):
    out = []
    for i, _, html in pages:
        body = (html or "").encode()
        same = [p for p, _, h in pages if (h or "").encode() == body and p is not None]
        newest = max(same, default=None)
        revisit = len(body) >= 1000 and newest is not None and i != newest
        out.append((i, len(body), hashlib.sha1(body).hexdigest(),
                    "revisit" if revisit else "response", newest if revisit else None))
    return ordered(out)


def test_against_brute_force(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    assert ordered(warc.read_archive(*warc.write_archive(pages)).collect()) == brute(PAGES)
    more = pages.select("*", *[F.lit("x").alias(c) for c in ("id", "address", "sha1", "newest")])
    assert ordered(warc.read_archive(*warc.write_archive(more)).collect()) == brute(PAGES)
    assert warc.read_archive(*warc.write_archive(pages.limit(0))).count() == 0


def test_payloads_are_stored_once_and_records_come_back(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    headers, blobs = warc.write_archive(pages)
    assert blobs.count() == len({h or "" for _, _, h in PAGES})
    assert headers.count() == len(PAGES)
    bodies = sorted((h or "").encode() for _, _, h in PAGES)
    rows = warc.read_records(headers, blobs).collect()
    assert sorted(bytes(r.payload) for r in rows) == bodies
    for r in rows:
        head, record = r.header, bytes(r.record)
        assert head.startswith("WARC/1.1\r\n") and head.endswith("\r\n\r\n")
        block = b"" if "WARC-Type: revisit\r\n" in head else bytes(r.payload)
        assert record == head.encode() + block + b"\r\n\r\n"
        assert f"Content-Length: {len(block)}\r\n" in head
        assert "\r\nX: y" not in head


def test_a_damaged_payload_is_found(spark):
    headers, blobs = warc.write_archive(spark.createDataFrame(PAGES, SCHEMA))
    bad = blobs.withColumn("payload", F.concat("payload", F.lit("!").cast("binary")))
    with pytest.raises(Exception, match="does not match its address"):
        warc.read_archive(headers, bad).collect()


def test_a_record_of_another_length_is_found(spark):
    headers, blobs = warc.write_archive(spark.createDataFrame(PAGES, SCHEMA))
    bad = headers.withColumn("header", F.replace("header", F.lit("Content-Length: 999"),
                                                 F.lit("Content-Length: 998")))
    with pytest.raises(Exception, match="not as long as its header says"):
        warc.read_archive(bad, blobs).collect()


def test_record_names_and_profiles(spark):
    """Every record is named, rows that differ are named apart, and a revisit has the
    profile and names the record of its response."""
    pages = spark.createDataFrame(PAGES, SCHEMA)
    heads = [(r.id, r.header) for r in warc.write_archive(pages)[0].collect()]
    def field(h, name):
        found = [x.split(": ", 1)[1] for x in h.split("\r\n") if x.startswith(name + ": ")]
        assert len(found) <= 1
        return found[0] if found else None
    names = [field(h, "WARC-Record-ID") for _, h in heads]
    assert all(n.startswith("<urn:") and n.endswith(">") for n in names)
    assert len(set(names)) == len(set(PAGES))
    responses = {field(h, "WARC-Record-ID"): i for i, h in heads if field(h, "WARC-Type") == "response"}
    revisits = [(i, h) for i, h in heads if field(h, "WARC-Type") == "revisit"]
    assert revisits
    for i, h in revisits:
        assert field(h, "WARC-Profile") == warc.REVISIT_PROFILE
        assert responses[field(h, "WARC-Refers-To")] is not None
    assert all(field(h, "WARC-Profile") is None for _, h in heads if field(h, "WARC-Type") == "response")


def test_a_payload_that_a_third_of_the_rows_share(spark):
    pages = [(i, f"u{i}", "z" * 1_500 if i % 3 == 0 else f"{i} " * 300) for i in range(1_500)]
    df = spark.createDataFrame(pages, SCHEMA).repartition(8)
    headers, blobs = warc.write_archive(df)
    assert blobs.count() == 1_001
    assert ordered(warc.read_archive(headers, blobs).collect()) == brute(pages)
