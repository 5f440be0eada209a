"""Archives: round trip and deduplication against a plain reading of the rules."""

import gzip
import hashlib

from tessera.llm import warc
from tessera.llm._common import read_table, scratch

PAGES = "page_id long, url string, html string"


def brute(rows):
    largest = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page_id is not None:
            largest[data] = max(page_id, largest.get(data, page_id))
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        target = largest.get(data, page_id) if page_id is not None else None
        again = target != page_id
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", target if again else None))
    return sorted(out, key=str)


def run(spark, df, **kw):
    manifest = warc.write_archives(df, scratch(spark, "w"), **kw)
    return manifest, warc.captures(spark, manifest)


def rows_of(captures):
    rows = captures.select("page_id", "response.payload_bytes", "response.payload_digest", "record_type", "refers_to").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_tables(spark):
    pages = read_table(spark, "/root/testdata/sf0.001", "pages")
    _, captures = run(spark, pages)
    assert rows_of(captures) == brute([tuple(r) for r in pages.collect()])
    html = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    for r in captures.collect():
        assert r["request"]["record_id"] and r["metadata"]["page_id"] == r["page_id"]
        if r["record_type"] == "response":
            assert bytes(r["response"]["payload"]).decode() == html[r["page_id"]]


def test_odd_rows(spark):
    big, edge, long = "é" * 600, "x" * 1000, "WARC/1.1\r\n\r\n" * 200_000
    rows = [(1, None, None), (2, "", ""), (3, "http://a/\r\nX: y z", big), (4, "http://b", big), (5, "http://b/é", edge), (6, None, edge),
            (6, None, edge), (7, "u", "x" * 999), (8, "u", "x" * 999), (9, "http://h", long), (None, "http://n", big), (None, None, None)]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "page_id AS digest", "url AS response_id")
    manifest, captures = run(spark, df, archive_bytes=2000)
    assert manifest.count() > 1
    assert rows_of(captures) == brute(rows)
    data = b"".join(open(r["path"].removeprefix("file:"), "rb").read() for r in manifest.collect())
    text = gzip.decompress(data)
    assert text.count(b"WARC-Type: request") == len(rows) and text.count(b"WARC-Type: warcinfo") == manifest.count()


def test_revisits_hold_the_response(spark):
    rows = [(i, f"http://h/{i}", "é" * 600 if i < 4 else "x" * i) for i in range(6)]
    _, captures = run(spark, spark.createDataFrame(rows, PAGES))
    out = {r["page_id"]: r for r in captures.collect()}
    assert sum(r["record_type"] == "revisit" for r in out.values()) == 3
    for page_id, _, html in rows:
        assert bytes(out[page_id]["response"]["payload"]).decode() == html
        target = out[page_id]["refers_to"] if out[page_id]["record_type"] == "revisit" else page_id
        assert out[page_id]["response"]["record_id"] == out[target]["response"]["record_id"]


def test_empty(spark):
    manifest, captures = run(spark, spark.createDataFrame([], PAGES))
    assert manifest.count() == captures.count() == 0
