"""WARC archives and the two-level index: exact round trip."""
import hashlib

from pyspark.sql import functions as F

from conftest import SF01
from tablerail.llm import warc as W


def want(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        f = first.get(b)
        again = f is not None and i is not None and f < i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_pages_round_trip(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    copies = pages.limit(60).withColumn("page_id", F.col("page_id") + 10000).withColumn("url", F.concat("url", F.lit("&again")))
    both = pages.unionByName(copies)
    rows = [(r.page_id, r.url, r.html) for r in both.collect()]
    assert got(W.round_trip(spark, both)) == want(rows)


def test_hot_urls_and_small_blocks(spark):
    rows = [(i, "http://hot.example/x" if i % 3 else f"http://{i % 7}.example:80/{i}#f", f"<p>{i % 11}</p>" * 20) for i in range(900)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    captures = W.write_archives(df)
    index = W.write_index(captures, block_lines=16, part_rows=100)
    assert index.count() > 3
    assert got(W.resolved(W.lookup(df, index))) == want(rows)
    one = W.lookup(spark.createDataFrame([("http://3.example/3",), ("http://nowhere.example/",), (None,)], "url string"), index)
    assert [r.page_id for r in one.collect()] == [3]


def test_edge_rows(spark):
    long = "<p>x</p>" * 200000
    rows = [(1, None, None), (2, "", ""), (3, "not a url\t\n", "é" * 60), (4, "http://[bad/", "é" * 60), (None, "http://a.b/", "é" * 60),
            (5, "http://a.b/", long), (5, "http://a.b/", long), (6, "http://a.b/é", long), (7, "http://a.b/?q=\r\n\r\n", "a\r\n\r\nb" * 30)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, size int")
    assert got(W.round_trip(spark, df)) == want(rows)
    assert W.round_trip(spark, df.limit(0)).count() == 0


def test_keys():
    assert W.url_key("https://Blog.A.example.com/en/1?x=2#top") == "com,example,a,blog)/en/1?x=2"
    assert W.url_key("http://a.b:80") == "b,a)/" and W.url_key("http://a.b:81/") == "b,a:81)/"
    assert W.url_key(None) == "" and "\t" not in W.url_key("a\tb")
