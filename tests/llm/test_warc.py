import hashlib
import re

import pytest

from intake.llm.warc import parse_records, read_archive, write_archive
from tests.conftest import SF_DIR


def slow(pages):
    """{page_id: what a reader finds} with no duplicate ids."""
    data = {p: (h or "").encode() for p, h in pages}
    out = {}
    for p, body in data.items():
        holder = max(q for q, other in data.items() if other == body)
        revisit = len(body) >= 1000 and p != holder
        out[p] = (len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", holder if revisit else None)
    return out


def read(df):
    return [(r.page_id, (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in df.collect()]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS address", "1 AS length", "'y' AS head")


def test_odd_pages(spark, folder):
    pages = [
        (1, "http://a/é?q=\r\nWARC-Type: revisit", "é" * 600), (5, None, "é" * 600), (3, "u", "é" * 600),
        (2, "http://b/", "é" * 499), (4, "http://b/", "é" * 499), (7, "x", None), (8, "x", ""),
        (6, "long", "long text " * 200000), (9, "u" * 90000, "WARC/1.1\r\n\r\n" * 200), (-4, "z", "WARC/1.1\r\n\r\n" * 200),
    ]
    write_archive(frame(spark, pages), folder)
    records = read_archive(spark, folder)
    assert dict(read(parse_records(records))) == slow([(p, h) for p, _, h in pages])
    bodies = {p: (h or "").encode() for p, _, h in pages}
    for r in records.collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        length = int(fields["Content-Length"])
        assert rest[length:] == b"\r\n\r\n"
        page = int(re.search(r":(-?\d+)>", fields["WARC-Record-ID"])[1])
        http, _, body = rest[:length].partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK")
        assert body == (bodies[page] if fields["WARC-Type"] == "response" else b"")
    stored = spark.read.parquet(f"{folder}/payloads")
    assert stored.count() == len(set(bodies.values()))


def test_rows_that_repeat_and_null_ids(spark, folder):
    text = "t" * 2000
    write_archive(frame(spark, [(5, "u", text), (5, "u", text), (None, "u", text), (4, "v", text)]), folder)
    got = sorted(read(parse_records(read_archive(spark, folder))), key=lambda r: r[0] or 0)
    assert [(p, x[2], x[3]) for p, x in got] == [(None, "revisit", 5), (4, "revisit", 5), (5, "response", None), (5, "response", None)]


def test_no_pages(spark, folder):
    write_archive(frame(spark, []), folder)
    assert read_archive(spark, folder).collect() == []


def test_a_changed_payload_is_noticed(spark, folder):
    write_archive(frame(spark, [(1, "u", "a" * 1500), (2, "u", "b")]), folder)
    stored = spark.read.parquet(f"{folder}/payloads").collect()
    other = {bytes(r.packed) for r in stored}
    swapped = [(r.address, r.length, (other - {bytes(r.packed)}).pop()) for r in stored]
    spark.createDataFrame(swapped, "address string, length long, packed binary").write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="payload lost or changed"):
        read_archive(spark, folder).collect()


def test_whole_table(spark, folder):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    write_archive(pages, folder)
    assert dict(read(parse_records(read_archive(spark, folder)))) == slow([(r.page_id, r.html) for r in pages.collect()])
