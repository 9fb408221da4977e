import gzip
import hashlib

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from agrolith.llm import warc as W
from agrolith.llm.queries import ORACLE_SQL, op2_warc


def plain(rows, least=1000):
    """What the contract says, row by row."""
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body and p is not None] if len(body) >= least else [page]
        refers = max(same, default=page)
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "response" if refers == page else "revisit", None if refers == page else refers))
    return sorted(out, key=str)


def back(spark, df, **kw):
    directory, folder = W.archive(df)
    return W.read_back(spark, df, directory, folder, **kw)


def test_against_sql(spark, sf):
    c = duckdb.connect()
    c.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    key = lambda x: (None if pd.isna(x.refers_to) else int(x.refers_to), x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.intact)
    assert sorted(map(key, op2_warc(spark, sf).toPandas().itertuples()), key=str) == sorted(map(key, c.sql(ORACLE_SQL["op2_warc"]).df().itertuples()), key=str)


def test_odd_pages(spark):
    long = "é" * 700
    rows = [(1, "http://b.a/x", long), (2, "http://b.a/x", long), (3, None, long), (4, "", None), (5, "http://[bad", ""), (6, "http://h/a b\r\nWARC-Type: x", "x" * 999), (7, "http://h/", "x" * 999), (8, "https://H:443/ü?q#f", "\r\n\r\nWARC/1.1\r\n"), (-9, "x", "y"), (None, "http://n/", "n" * 2000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, key string")
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back(spark, df).collect()), key=str)
    assert got == plain(rows)
    bodies = {r.page_id: bytes(r.payload) for r in back(spark, df, payload=True).where("record_type = 'response'").collect()}
    assert bodies[8] == b"\r\n\r\nWARC/1.1\r\n" and bodies[3] == long.encode()


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a/", "h" * 1500)] * 3, "page_id long, url string, html string")
    assert [r.record_type for r in back(spark, df).collect()] == ["response"] * 3
    assert back(spark, df.where("false")).count() == 0


def test_index_finds_by_range_reads(spark, sf, monkeypatch):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    folder = W.scratch(spark, "t")
    captures = W.write(pages, f"{folder}/archive", archive=20_000)
    directory = W.build_index(captures, f"{folder}/index", block=3)
    assert captures.select("path").distinct().count() > 3 and directory.count() >= pages.count() / 3
    rows = directory.orderBy("first_key").collect()
    assert all(a.last_key <= b.first_key for a, b in zip(rows, rows[1:], strict=False))
    some = pages.where("page_id % 7 = 0")
    found = W.read_back(spark, some, directory, folder).collect()
    assert sorted(r.page_id for r in found) == sorted(r.page_id for r in some.collect()) and all(r.intact for r in found)
    missing = spark.createDataFrame([("zzz 1",), ("", )], "key string")
    assert W.lookup(missing, directory, f"{folder}/index").count() == 0


def test_archives_are_plain_warc(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    folder = W.scratch(spark, "t")
    captures = W.write(pages, folder)
    path = captures.first().path
    with gzip.open(f"{folder.removeprefix('file://')}/{path}") as f:
        text = f.read()
    assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
    n = at = 0
    while at < len(text):
        head, _, rest = text[at:].partition(b"\r\n\r\n")
        size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length:")).split(b":")[1])
        assert rest[size : size + 4] == b"\r\n\r\n"
        at, n = at + len(head) + 4 + size + 4, n + 1
    assert n == captures.where(F.col("path") == path).count()


@pytest.mark.parametrize("url, key", [("http://Blog.Example.com/a?b", "com,example,blog)/a?b"), ("https://x.org:8080", "org,x:8080)/"), ("http://x.org:80/p#f", "org,x)/p"), ("no host", "no host"), ("http://10.1.2.3/x", "10.1.2.3)/x"), ("http://[::1]:8/", "::1:8)/")])
def test_reversed_hosts(url, key):
    assert W.surt(url) == key


def test_many_groups_meet_their_pages_in_a_shuffle(spark):
    rows = [(i, "u", f"payload {i % 7} " * 200) for i in range(50)] + [(100 + i, f"u{i % 3}", "hot " * 400) for i in range(3000)] + [(None, "n", "hot " * 400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    key = lambda r: (r.page_id, r.size, r.digest, r.refers_to)
    assert sorted(map(key, W.with_originals(df, sent=0).collect()), key=str) == sorted(map(key, W.with_originals(df).collect()), key=str)


def test_segments_under_a_top_level(spark, sf, monkeypatch):
    """Many segments under several rows of the top level; keys at their ends and keys that lie nowhere."""
    monkeypatch.setattr(W, "FAN", 3)
    monkeypatch.setattr(W, "SEGMENT", 2)
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    folder = W.scratch(spark, "t")
    directory = W.build_index(W.write(pages, f"{folder}/archive"), f"{folder}/index", block=4)
    assert directory.select("segment").distinct().count() > 12
    wanted = W.keys(pages).union(spark.createDataFrame([("a",), ("com,zz)/ 1",), ("~",)], "key string"))
    assert W.lookup(wanted, directory, f"{folder}/index").count() == pages.count()
