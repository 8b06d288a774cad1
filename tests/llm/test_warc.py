from __future__ import annotations

import base64
import hashlib

import duckdb
import pytest
from odd import LONG

from subledger.llm import warc
from subledger.llm.queries import ORACLE_SQL, op1_url_filters, op10_warc

SF = "/root/testdata/sf0.001"
ROWS = [
    (1, "http://a/", "same"), (5, "http://b/", "same"), (3, None, "same"), (2, "http://c/\r\nX: y", "other"), (4, "u", None), (9, "u", ""),
    (None, "u", "same"), (None, None, None), (7, "u", "twice"), (7, "u", "twice"), (8, "u", LONG), (6, "u", "é<html>"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x") for r in ROWS], "page_id bigint, url string, html string, digest string")


def test_records(spark, pages):
    archive = warc.write(pages)
    assert archive.payloads.count() == 6 and archive.records.count() == len(ROWS)
    found = warc.read(archive).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str)
    want, seen = [], {}
    for page, _, html in ROWS:
        seen.setdefault(html or "", []).append(page)
    for html, ids in seen.items():
        raw = html.encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        ids = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        want += [(i, len(raw), digest, "revisit" if n else "response", ids[0] if n else None) for n, i in enumerate(ids)]
    assert got == sorted(want, key=str)


def test_whole_records_come_back(spark, pages):
    for r in warc.read(warc.write(pages)).collect():
        head, _, body = bytes(r.warc).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and fields[b"WARC-Type"].decode() == r.record_type
        assert body == (bytes(r.payload) if r.record_type == "response" else b"") + b"\r\n\r\n"
        assert int(fields[b"Content-Length"]) == len(body) - 4
        assert b"X" not in fields and fields[b"WARC-Payload-Digest"] == b"sha1:" + r.payload_digest.encode()
        assert (b"WARC-Refers-To" in fields) == (r.record_type == "revisit")


def test_small_payloads_are_not_shared(spark, pages):
    found = warc.read(warc.write(pages, least_bytes=5)).collect()
    assert {r.record_type for r in found if r.payload_bytes < 5} == {"response"}
    assert {r.record_type for r in found if r.page_id == 7} == {"response", "revisit"}


def test_a_damaged_payload_is_noticed(spark, pages):
    archive = warc.write(pages)
    from pyspark.sql import functions as F

    damaged = archive.payloads.withColumn("payload", F.concat("payload", F.lit(b"!")))
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read(warc.Archive(archive.records, damaged)).collect()


def test_empty(spark, pages):
    assert warc.read(warc.write(pages.limit(0))).collect() == []


@pytest.mark.parametrize("query", [op1_url_filters, op10_warc])
def test_sql_says_the_same(spark, query):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{SF}/pages.parquet'")
    sql = con.sql(ORACLE_SQL[query.__name__])
    found = query(spark, SF)
    columns = sorted(sql.columns)
    assert sorted(found.columns) == columns
    assert sorted(map(str, sql.select(", ".join(columns)).fetchall())) == sorted(str(tuple(r)) for r in found.select(*columns).collect())
