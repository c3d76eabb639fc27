import base64
import gzip
import hashlib
import random

import pytest
from conftest import SF_SMALL

from seclake.llm import queries, warc


def brute(rows):
    first = {}
    for i, _, html in rows:
        first[html or ""] = min((x for x in (first.get(html or ""), i) if x is not None), default=None)
    out = []
    for i, _, html in rows:
        data, f = (html or "").encode(), first[html or ""]
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if i == f else "revisit", None if i == f else f))
    return sorted(out, key=repr)


ODD = [(1, "http://a.example/x", "one"), (2, "http://a.example/x", "one"), (3, None, None), (4, "http://b.example/", ""), (5, "https://www.b.example:8080/p/?b=2&a=1#f", "\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\n\r\n"),
       (6, "not a url", "\n"), (7, "http://[bad", "é中\U0001f600"), (8, "line\r\nbreak", "x" * 500_000), (None, "http://a.example/x", "one"), (None, "u", "only null ids"), (None, "u", "only null ids"), (1, "http://a.example/x", "one"),
       (-5, "http://a.example/?q=%20%C3%A9", "neg")]


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS", 3)
    pages = spark.createDataFrame([(i, u, h, "x", 0) for i, u, h in ODD], "page_id long, url string, html string, row string, payload int").repartition(3)
    index = warc.archive(pages)
    got = index.collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=repr) == brute(ODD)
    order = sorted(got, key=lambda r: r.position)
    assert [warc.capture_order(tuple(r)) for r in order] == sorted(warc.capture_order(tuple(r)) for r in got)
    assert len({r.position for r in got}) == len(got)


def test_payloads_come_back(spark, scratch):
    pages = spark.createDataFrame([(i, u, h) for i, u, h in ODD], "page_id long, url string, html string")
    warc.write_archives(warc.decided(pages), scratch + "/w")
    from pathlib import Path
    payloads = [b.partition(b"\r\n\r\n")[2].decode() for f in Path(scratch, "w").glob("part-*") for h, b, _, _ in warc.parse(gzip.decompress(f.read_bytes())) if h["WARC-Type"] == "response"]
    assert set(payloads) == {h or "" for _, _, h in ODD} and len(payloads) == sum(r[3] == "response" for r in brute(ODD))


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([*ODD, (20, "u", "four"), (21, "u", "four")], "page_id long, url string, html string")
    kinds = [(r.payload_bytes, r.record_type) for r in warc.archive(pages, least_bytes=4).collect()]
    assert all(k == "response" for n, k in kinds if n < 4) and ("revisit" in {k for n, k in kinds if n >= 4})


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree(k):
    draw = random.Random(k)
    runs = [sorted(draw.randint(0, 20) for _ in range(draw.choice([0, 1, 5, 30]))) for _ in range(k)]
    assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


@pytest.mark.parametrize("url,key", [("http://www.Example.com/A/b/?z=1&a=2#x", "com,example)/a/b?a=2&z=1"), ("https://example.com", "com,example)/"), (None, ""), ("//x", "x)/")])
def test_url_key(url, key):
    assert warc.url_key(url) == key


def test_pages_table(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    assert sorted(map(tuple, queries.op5(spark, SF_SMALL).collect()), key=repr) == brute(rows)


def test_empty(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
