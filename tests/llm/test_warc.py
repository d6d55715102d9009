"""WARC derivatives: links between records, digests, headers, and text on odd pages."""

import base64
import hashlib
import re

import pytest

from changeflow.llm import warc
from changeflow.llm.catalog import QUERIES


def sha1(block):
    return "sha1:" + base64.b32encode(hashlib.sha1(block.encode()).digest()).decode()


def records(spark, rows):
    schema = "record_id string, target_uri string, date string, http_header string, payload string, block string, r string"
    full = [(f"<urn:uuid:{i}>", *row, "own block", "own r") for i, row in enumerate(rows)]
    return warc.serialised(warc.derivatives(spark.createDataFrame(full, schema))).collect()


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b<br>c", "a\nb\nc"), ("x<script>if (a<b) {}</script >y<style>p{}</style>z", "x y z"),
    ("a<!-- <p>no --> b", "a b"), ("a<!-- never closed <p>b", "a"), ("<script>never closed", ""), ("<header>top</header><b>in</b>line", "top\ninline"),
    ("&lt;p&gt; &amp;amp; &#233;&#xE9;&#x1F600; &unknown; & &#0;&#xD800;&#9999999;", "<p> &amp; éé\U0001F600 &unknown; & ���"),
    ("a < b and c > d", "a < b and c > d"), ("  many \t blanks \n\n\n lines ", "many blanks\nlines"), ("<HEAD><title>T</title></HEAD><BODY>b</BODY>", "b"),
])
def test_text(spark, html, text):
    by = {r.warc_type: r for r in records(spark, [("http://x/", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nX-A: 1", html)])}
    assert by["conversion"].block == text


def test_open_heads_links_and_entities(spark):
    rows = [(None, None, None, html) for html in (
        "<head><title>T</title><body>text <a href='/one'>1</a>", "<head><meta charset=x><title>T</title><p>all<header>top</header><a class=x href=/two>2</a>",
        '<A HREF = "/three" title=\'x\'>&eacute;&uuml;&CounterClockwiseContourIntegral;&frac12;&nbsp;&unknown;</A><a data-href="/no">n</a>')]
    got = {(r.refers_to[-2], r.warc_type): r.block for r in records(spark, rows)}
    assert [got[str(i), "conversion"] for i in range(3)] == ["text 1", "all\ntop\n2", "éü∳½ &unknown;n"]
    assert [[f for f in got[str(i), "metadata"].split("\r\n") if f.startswith("outlink")] for i in range(3)] == [["outlink: /one"], ["outlink: /two"], ["outlink: /three"]]


def test_links_and_digests(spark):
    html = '<html lang="de"><head><title> A &amp; B\n</title></head><body><a href="/one">1</a><a class=x href="http://two">2</a></body></html>'
    rows = [("http://x/", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-Y: z", html), (None, None, None, None)]
    got = records(spark, rows)
    assert len(got) == 4 and len({r.record_id for r in got}) == 4
    for r in got:
        assert r.block_digest == sha1(r.block) and f"WARC-Block-Digest: {sha1(r.block)}\r\n" in r.header
        assert f"Content-Length: {len(r.block.encode())}\r\n" in r.header
        assert r.source.record_id == r.refers_to and f"WARC-Refers-To: {r.refers_to}\r\n" in r.header and r.source.block == "own block"
        assert bytes(r.record) == (r.header + "\r\n" + r.block + "\r\n\r\n").encode() and r.header.startswith("WARC/1.1\r\n")
    one = {r.warc_type: r for r in got if r.refers_to == "<urn:uuid:0>"}
    fields = one["metadata"].block.split("\r\n")
    assert "title: A & B" in fields and "language: de" in fields and [f for f in fields if f.startswith("outlink")] == ["outlink: /one", "outlink: http://two"]
    assert [f for f in fields if f.startswith("source-header")] == ["source-header: HTTP/1.1 200 OK", "source-header: Content-Type: text/html", "source-header: X-Y: z"]
    assert f"source-payload-digest: {sha1(html)}" in fields and f"source-block-digest: {sha1(rows[0][2] + chr(13) + chr(10) + chr(13) + chr(10) + html)}" in fields
    assert f"conversion: {one['conversion'].record_id}" in fields and f"conversion-digest: {one['conversion'].block_digest}" in fields
    assert f"WARC-Concurrent-To: {one['metadata'].record_id}\r\n" in one["conversion"].header
    other = [r for r in got if r.refers_to == "<urn:uuid:1>"]
    assert all("WARC-Target-URI" not in r.header and "WARC-Date" not in r.header for r in other)


def test_same_page_same_records(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    one = warc.derivatives(warc.page_responses(df)).select("record_id", "block_digest")
    two = warc.derivatives(warc.page_responses(df.unionByName(df))).select("record_id", "block_digest").distinct()
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert warc.derivatives(warc.page_responses(df.limit(0))).count() == 0


def test_query(spark, sf_dir):
    rows = QUERIES["op1_warc_derivatives"](spark, sf_dir).collect()
    assert len(rows) == 2 * spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", r.record_id) for r in rows)
