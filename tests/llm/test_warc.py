"""Revisit resolution against a plain as-of search; parsing; merging."""

import datetime as dt
import random

from jobmart.llm import warc

SCHEMA = "record_id string, kind string, url string, date timestamp, status string, headers array<struct<name:string,value:string>>, body string, url_key string"


def capture(i, kind, url, minute, etag=None, modified=None, body="", **more):
    headers = [(k, v) for k, v in {"etag": etag, "last-modified": modified, **more}.items() if v is not None]
    when = None if minute is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
    return (i, kind, url, when, "200" if kind == "response" else "304", headers, body, "clash")


def test_canonical(spark):
    same = ["HTTP://Www.Example.com:80/a/?b=2&a=1#x", "https://www.example.com/a?a=1&b=2&utm_source=q&ref=z", "www.example.com/a?a=1&b=2"]
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(u,) for u in [*same, None, ""]], "u string").select(warc.canonical(F.col("u")).alias("k")).collect()
    assert [r.k for r in rows] == ["www.example.com/a?a=1&b=2"] * 3 + [None, ""]


def test_as_of_equals_plain_search(spark):
    r = random.Random(4)
    rows = [capture(f"r{i:04d}", r.choice(["response", "revisit"]), r.choice(["http://hot.example.com/"] * 8 + ["http://b.example.com/x", "http://c.example.com"]), r.randint(0, 600), etag=r.choice(['"1"', 'W/"1"', '"2"'])) for i in range(400)]
    for seconds in (60, 3600, 86400 * 30):
        out = {x.record_id: x for x in warc.resolve(spark.createDataFrame(rows, SCHEMA), seconds).collect()}
        for i, kind, url, when, _, headers, *_ in rows:
            if kind == "revisit":
                before = [(x[3], x[0], x[5]) for x in rows if x[1] == "response" and x[2] == url and x[3] < when]
                best = max(before, default=None)
                same = best and best[2][0][1].removeprefix("W/") == headers[0][1].removeprefix("W/")
                assert (out[i].refers_to, out[i].status) == (best and best[1], "unresolved" if not best else "resolved" if same else "validator_mismatch")
        assert len(out) == sum(x[1] == "revisit" for x in rows)


def test_validators_and_merging(spark):
    rows = [capture("a", "response", "u.example.com/1", 0, etag='"x"', body="hello", **{"content-type": "text/html", "cache-control": "max-age=1", "content-length": "5"}),
            capture("b", "revisit", "u.example.com/1", 5, etag='W/"x"', **{"cache-control": "max-age=9", "content-type": "text/plain", "content-length": "0"}),
            capture("c", "response", "u.example.com/2", 0, modified="Mon"), capture("d", "revisit", "u.example.com/2", 5, modified="Mon"), capture("e", "revisit", "u.example.com/2", 6, modified="Tue"),
            capture("f", "revisit", "u.example.com/2", 6), capture("g", "revisit", None, 6), capture("h", "revisit", "u.example.com/1", None, etag='"x"'), capture("i", "revisit", "u.example.com/1", 0, etag='"x"')]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {x.record_id: x for x in warc.with_bodies(warc.resolve(df), df).collect()}
    assert {k: v.status for k, v in out.items()} == {"b": "resolved", "d": "resolved", "e": "validator_mismatch", "f": "validator_mismatch", "g": "unresolved", "h": "unresolved", "i": "unresolved"}
    assert [tuple(h) for h in out["b"].headers] == [("cache-control", "max-age=9"), ("content-length", "5"), ("content-type", "text/html"), ("etag", 'W/"x"')]
    assert out["b"].body == "hello" and out["e"].body is None


def test_parse(spark):
    record = "WARC/1.1\r\nWARC-Type: Response\r\nWARC-Record-ID: <urn:1>\r\nWARC-Target-URI: http://x/y\r\nWARC-Date: 2024-01-02T03:04:05Z\r\n\r\nHTTP/1.1 200 OK\r\nETag: \"a:b\"\r\nSet-Cookie: p=1\r\nSet-Cookie: q=2\r\n\r\nbody\r\n\r\nmore"
    rows = warc.parse(spark.createDataFrame([(record,), (None,), ("",)], "record string")).collect()
    assert (rows[0].record_id, rows[0].kind, rows[0].status, rows[0].body) == ("<urn:1>", "response", "200", "body\r\n\r\nmore")
    assert [tuple(h) for h in rows[0].headers] == [("etag", '"a:b"'), ("set-cookie", "p=1"), ("set-cookie", "q=2")] and rows[1].record_id is None


def test_pages_with_nulls_repeats_and_none(spark):
    df = spark.createDataFrame([(3, "http://a/1", "x"), (3, "http://a/1", "x"), (None, None, None)], "page_id bigint, url string, html string")
    assert warc.revisits_report(df).count() == 6
    assert warc.revisits_report(df.where("false")).count() == 0
