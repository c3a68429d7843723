"""WARC records: parsing, and resolving not-modified revisits.

A revisit record holds the headers of a 304 answer and no body. It is resolved against the latest earlier
full response of the same canonical URL: the validators must agree (ETag compared weakly, else
Last-Modified), and the headers a 304 may update replace those of the stored response.

The as-of join has no window over a whole URL. Captures are cut into time buckets: inside a bucket a range frame
finds the latest strictly earlier response, and the last response of every bucket is carried forward over
the (few) buckets of the URL. A URL with a third of all captures is so split over its buckets. Only
validators, headers and ids move; bodies stay with their records until :func:`with_bodies`.

Defined results: a null URL, date or record id is never resolved (status ``unresolved``); equal times do not count as
earlier; of responses at the same time the larger record id wins; repeated rows are kept each; extra columns
of the input are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmart.llm.common import staged
from jobmart.sources.tables import checked_broadcast

BUCKET_SECONDS = 3600
#: Headers that a 304 answer may update in the stored response.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "server", "set-cookie", "vary", "via", "warning")
#: Query parameters that do not select content.
_TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def canonical(url: Column) -> Column:
    """Scheme, fragment, default port, tracking parameters, parameter order and a trailing slash do not count."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    u = F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(u, "^([^/?]*)", 1)), ":(80|443)$", "")
    rest = F.regexp_replace(u, "^[^/?]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, "\\?(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda q: (q != "") & ~q.rlike(_TRACKING))), "&")
    return F.when(url.isNotNull(), F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))


def _headers(block: Column) -> Column:
    """Header lines as an array of (name, value), names in lower case; lines without a colon are left out."""
    lines = F.filter(F.split(block, "\r\n"), lambda x: F.instr(x, ":") > 1)
    return F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"),
                                                 F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("value")))


def header(headers: Column, name: str) -> Column:
    """The first value of a header, null if there is none."""
    return F.get(F.filter(headers, lambda h: h["name"] == name), 0)["value"]


def parse(records: DataFrame, record_col: str = "record") -> DataFrame:
    """WARC records (text: WARC headers, blank line, HTTP headers, blank line, body) as columns."""
    r = F.col(record_col)
    d = records.select(F.split(r, "\r\n\r\n", 3).alias("_p"))
    d = d.select(_headers(F.get("_p", 0)).alias("_w"), F.get("_p", 1).alias("_http"), F.coalesce(F.get("_p", 2), F.lit("")).alias("body"))
    return d.select(
        header(F.col("_w"), "warc-record-id").alias("record_id"), F.lower(header(F.col("_w"), "warc-type")).alias("kind"),
        header(F.col("_w"), "warc-target-uri").alias("url"), F.try_to_timestamp(header(F.col("_w"), "warc-date")).alias("date"),
        F.regexp_extract(F.col("_http"), "^HTTP/[0-9.]+ ([0-9]{3})", 1).alias("status"), _headers(F.col("_http")).alias("headers"), "body")


def merged(stored: Column, update: Column) -> Column:
    """The stored headers with those the 304 may update replaced; sorted by name, then value."""
    fresh = F.filter(update, lambda h: h["name"].isin(*PERMITTED))
    names = F.transform(fresh, lambda h: h["name"])
    return F.array_sort(F.concat(F.filter(stored, lambda h: ~F.array_contains(names, h["name"])), fresh))


def _one_per_id(rows: DataFrame) -> DataFrame:
    """One row for each ``_id``. Only ids that occur again (in practice none) pass through an aggregate."""
    again = checked_broadcast(rows.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("_id").alias("_again")))
    same = F.col("_id") == F.col("_again")
    return rows.join(again, same, "left_anti").unionByName(rows.join(again, same, "left_semi").dropDuplicates(["_id"]))


def _etag(headers: Column) -> Column:
    return F.regexp_replace(header(headers, "etag"), "^W/", "")


def resolve(captures: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """One row per revisit: the response it refers to, why or why not, and the merged headers.

    ``status`` is ``resolved``, ``validator_mismatch`` (an earlier response, other validators) or
    ``unresolved`` (no earlier response).
    """
    c = captures.select("record_id", "kind", "status", canonical(F.col("url")).alias("url_key"), "date", "headers")
    c = c.withColumns({"_t": F.unix_micros("date"), "_full": (F.col("kind") == "response") & (F.col("status") == "200"),
                       "_revisit": (F.col("kind") == "revisit") & (F.col("status") == "304")}).where("_full or _revisit")
    c = c.withColumn("_bucket", F.floor(F.col("_t") / (bucket_seconds * 1_000_000)))
    full = F.when(F.col("_full") & F.col("_t").isNotNull() & F.col("url_key").isNotNull(), F.struct("_t", "record_id", "headers"))
    last = c.where("_full and _t is not null and url_key is not null").groupBy("url_key", "_bucket").agg(F.max(F.struct("_t", "record_id")).alias("_last"))
    # every bucket that has captures, with the last response of the buckets before it
    here = c.where("url_key is not null and _t is not null").select("url_key", "_bucket").distinct()
    over = Window.partitionBy("url_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (here.join(last, ["url_key", "_bucket"], "left")
               .select(F.col("url_key").alias("_k"), F.col("_bucket").alias("_b"), F.max("_last").over(over)["record_id"].alias("_earlier")))
    inside = Window.partitionBy("url_key", "_bucket").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    near = c.withColumn("_near", F.max(F.when(full.isNotNull(), F.struct("_t", "record_id"))).over(inside)["record_id"]).where("_revisit")
    r = near.join(carried, (F.col("url_key") == F.col("_k")) & (F.col("_bucket") == F.col("_b")), "left")
    r = r.select("record_id", "url_key", "date", "headers", F.when(F.col("_t").isNotNull() & F.col("url_key").isNotNull(), F.coalesce("_near", "_earlier")).alias("_to"))
    stored = c.where("_full").select(F.col("record_id").alias("_id"), F.col("headers").alias("_stored"), F.col("date").alias("refers_to_date")).where("_id is not null")
    # written first: many revisits may refer to one response, and only a join of two plain shuffles can be split there
    stored = staged(_one_per_id(stored), "responses")
    r = r.join(stored, F.col("_to") == F.col("_id"), "left")
    new, old = F.col("headers"), F.col("_stored")
    same = F.coalesce(_etag(new) == _etag(old), header(new, "last-modified") == header(old, "last-modified"), F.lit(False))
    status = F.when(F.col("_to").isNull(), "unresolved").when(same, "resolved").otherwise("validator_mismatch")
    r = r.withColumn("status", status)
    ok = F.col("status") == "resolved"
    return r.select("record_id", "url_key", "date", "status", F.col("_to").alias("refers_to"), "refers_to_date",
                    F.when(ok, merged(old, new)).alias("headers"))


def with_bodies(resolved: DataFrame, captures: DataFrame) -> DataFrame:
    """The resolved revisits as full responses: the body comes from the response referred to."""
    bodies = captures.where("kind = 'response' and record_id is not null").select(F.col("record_id").alias("_id"), F.col("body"))
    bodies = _one_per_id(bodies)
    return (resolved.join(bodies, (F.col("refers_to") == F.col("_id")) & (F.col("status") == "resolved"), "left").drop("_id"))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """The pages table as WARC records: each page's response, and revisits as a re-crawl would leave them.

    A page with id p is fetched (7919 p mod 2592000) seconds into June 2024. p mod 3 = 0 has two revisits (1 and
    26 hours later), 1 has one (5 hours later, weak ETag), 2 has none; p mod 10 = 7 adds one with a changed
    ETag (30 hours later), 9 one that is earlier than the response (2 hours).
    """
    p = F.coalesce(F.col("page_id"), F.lit(0).cast("bigint"))
    html = F.coalesce(F.col("html"), F.lit(""))
    d = pages.select(p.alias("p"), F.coalesce("url", F.lit("")).alias("url"), html.alias("html"), F.concat(F.lit('"'), F.substring(F.md5(html), 1, 12), F.lit('"')).alias("tag"),
                     (F.lit(1717200000) + (p * 7919) % 2592000).alias("t0"))
    row = lambda n, shift, tag, when: F.when(when, F.struct(F.lit(n).alias("n"), F.lit(shift).alias("shift"), tag.alias("tag")))
    yes, tag = F.lit(True), F.col("tag")
    plan = F.array(row(0, 0, tag, yes), row(1, 3600, tag, F.col("p") % 3 == 0), row(2, 93600, tag, F.col("p") % 3 == 0),
                   row(3, 18000, F.concat(F.lit("W/"), tag), F.col("p") % 3 == 1), row(4, 108000, F.lit('"changed"'), F.col("p") % 10 == 7), row(5, -7200, tag, F.col("p") % 10 == 9))
    d = d.select("*", F.explode(F.filter(plan, lambda x: x.isNotNull())).alias("c")).select("p", "url", "html", "t0", "c.*", F.timestamp_seconds(F.col("t0") + F.col("c.shift")).alias("ts"))
    full, nl = F.col("n") == 0, "\r\n"
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    warc = F.concat(F.lit(f"WARC/1.1{nl}WARC-Type: "), F.when(full, "response").otherwise("revisit"), F.lit(f"{nl}WARC-Record-ID: <urn:page:"), F.col("p").cast("string"), F.lit(":"), F.col("n").cast("string"),
                    F.lit(f">{nl}WARC-Target-URI: "), F.col("url"), F.lit(f"{nl}WARC-Date: "), stamp, F.lit(nl * 2))
    http = F.concat(F.when(full, f"HTTP/1.1 200 OK{nl}Content-Type: text/html; charset=utf-8{nl}Content-Length: ").otherwise(f"HTTP/1.1 304 Not Modified{nl}Content-Length: "),
                    F.when(full, F.octet_length("html")).otherwise(0).cast("string"), F.lit(f"{nl}Date: "), stamp, F.lit(f"{nl}Cache-Control: max-age="), (F.col("n") * 60).cast("string"),
                    F.lit(f"{nl}ETag: "), F.col("tag"), F.lit(nl * 2))
    return d.select(F.concat(warc, http, F.when(full, F.col("html")).otherwise(F.lit(""))).alias("record"))


def revisits_report(pages: DataFrame) -> DataFrame:
    """Records of ``pages`` parsed, their revisits resolved and given their bodies, as comparable columns."""
    captures = staged(parse(records_of_pages(pages)), "captures")
    r = with_bodies(resolve(captures), captures)
    return r.select("record_id", "url_key", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("captured"), "status", "refers_to",
                    F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n").alias("headers"),
                    F.length("body").cast("bigint").alias("body_chars"), F.md5("body").alias("body_md5"))
