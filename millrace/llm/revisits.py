"""WARC revisits of the kind "not modified": the full response each stands for, and its headers.

A revisit record says that a page had not changed. It is joined, as of its time, to the latest earlier full
response of the same canonical URL; the validators of both must agree; and the headers that a 304 may carry
take the place of the response's.

The join works on records in order of URL, time and record id, cut into blocks of about equal size wherever that
falls, within a URL too: a window looks back within a block, and the last response of the earlier blocks
of the URL is carried over. So a URL with a third of all records is spread over many tasks. Blocks
are a written table, as the cuts come from a sample. Payloads stay where they are: the result names the
response.

Canonical URL: no scheme, no user, no default port, no fragment, no leading "www."; host in lower case; no
slash at the end of the path; parameters sorted, without utm_* and ref.

Defined results, by ``status``: "no url" (null or without a host), "no earlier response" (none, or the revisit
has no time), "no validator" (the two have neither entity tags nor modification times in common),
"validator mismatch" (tags differ, weak marks aside; or, without two tags, times differ), "merged" (has
headers). Earlier means a smaller time, then a smaller id, then response before revisit; null ids come
first. Responses without a time never serve. Repeated records each count. Header names are compared in
lower case, of equal names the first in order of code points stays; null headers are none. Empty tables
give empty results. Further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import register, staged, table

# Headers that a 304 response sends in place of the stored ones (fixed values).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    plain = F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    plain = F.split_part(plain, F.lit("#"), F.lit(1))
    query = F.regexp_extract(plain, r"\?(.*)$", 1)
    place = F.regexp_extract(plain, r"^([^?]*)", 1)
    host = F.lower(F.regexp_extract(place, r"^(?:[^/@]*@)?([^/]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)?$", ""), r"^www\.", "")
    path = F.rtrim(F.regexp_extract(place, r"^[^/]*(/.*)?$", 1), F.lit("/"))
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[^=]*|ref)(=|$)"))
    query = F.array_join(F.array_sort(kept), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def lower_names(headers: Column) -> Column:
    """Headers by lower-case name; of names equal then, the first in order of code points."""
    entries = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.transform(entries, lambda e: e["key"])
    first = F.filter(entries, lambda e, i: F.array_position(names, e["key"]) == i + 1)
    return F.coalesce(F.map_from_entries(first), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def merged_headers(stored: Column, sent: Column) -> Column:
    sent = F.map_filter(lower_names(sent), lambda k, v: k.isin(*PERMITTED))
    stored = F.map_filter(lower_names(stored), lambda k, v: ~F.array_contains(F.map_keys(sent), k))
    return F.map_concat(stored, sent)


def _strong(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """record_id, url_key, status, response_id, response_time and headers for each revisit.

    ``records`` has record_id, url, time (long), kind ("response" or "revisit"), etag, last_modified
    and headers (map of strings).
    """
    rows = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), "time", "kind", "etag", "last_modified", "headers"
    )
    usable = F.col("url_key").isNotNull() & F.col("time").isNotNull()
    order = ["time", "record_id", "kind"]
    dealt = staged(
        rows.where(usable).repartitionByRange("url_key", *order).withColumn("block", F.spark_partition_id()), "revisit-blocks"
    )
    response = F.when(F.col("kind") == "response", F.struct("record_id", "time", "etag", "last_modified", "headers"))
    before = Window.partitionBy("url_key", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    near = dealt.withColumn("near", F.last(response, ignorenulls=True).over(before)).where("kind = 'revisit'")
    ends = dealt.where("kind = 'response'").groupBy("url_key", "block").agg(
        F.max_by(F.struct("record_id", "time", "etag", "last_modified", "headers"), F.struct("time", "record_id")).alias("last")
    )
    # Every block of a URL, with or without a response: a row for each, however many records it has.
    blocks = dealt.select("url_key", "block").distinct().join(ends, ["url_key", "block"], "left")
    earlier = Window.partitionBy("url_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = staged(
        blocks.withColumn("far", F.last("last", ignorenulls=True).over(earlier)).where("far is not null").select("url_key", "block", "far"),
        "revisit-carried",
    )
    joined = near.join(carried, ["url_key", "block"], "left").withColumn("found", F.coalesce("near", "far"))
    lost = rows.where(~usable & (F.col("kind") == "revisit")).select(
        "record_id", "url_key", "etag", "last_modified", "headers", F.lit(None).cast(joined.schema["found"].dataType).alias("found")
    )
    both = joined.select(lost.columns).unionByName(lost)
    tags = F.col("etag").isNotNull() & F.col("found.etag").isNotNull()
    times = F.col("last_modified").isNotNull() & F.col("found.last_modified").isNotNull()
    same = F.when(tags, _strong(F.col("etag")) == _strong(F.col("found.etag"))).otherwise(
        F.col("last_modified") == F.col("found.last_modified")
    )
    status = (
        F.when(F.col("url_key").isNull(), "no url")
        .when(F.col("found").isNull(), "no earlier response")
        .when(~tags & ~times, "no validator")
        .when(~same, "validator mismatch")
        .otherwise("merged")
    )
    return both.withColumn("status", status).select(
        "record_id",
        "url_key",
        "status",
        F.col("found.record_id").alias("response_id"),
        F.col("found.time").alias("response_time"),
        F.when(F.col("status") == "merged", merged_headers(F.col("found.headers"), F.col("headers"))).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """A crawl log of the pages: each was visited five times.

    Visits 0 and 2 fetched it whole (0 only for pages whose id is no multiple of 7), with the digest of
    the page, and of the page and the visit, as entity tag; visits 1 and 3 found it unchanged; visit 4
    sent the tag of visit 0 and no modification time.
    """
    visits = pages.select("page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("digest"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("visit"))
    whole = ((F.col("visit") == 0) & (F.col("page_id") % 7 != 0)) | (F.col("visit") == 2)
    version = F.when(F.col("visit").isin(2, 3), F.md5(F.concat("digest", F.lit("2")))).otherwise(F.col("digest"))
    time = F.col("visit") * 1000000 + F.col("page_id") % 1000
    return visits.select(
        (F.col("page_id") * 5 + F.col("visit")).alias("record_id"),
        "url",
        time.alias("time"),
        F.when(whole, "response").otherwise("revisit").alias("kind"),
        F.concat(F.when(F.col("visit") == 3, 'W/"').otherwise('"'), version, F.lit('"')).alias("etag"),
        F.when(F.col("visit") < 4, F.concat(F.lit("day "), F.floor(F.col("visit") / 2).cast("string"))).alias("last_modified"),
        F.map_concat(
            F.create_map(F.lit("Date"), time.cast("string"), F.lit("Content-Type"), F.when(whole, "text/html").otherwise("none")),
            F.create_map(F.lit("ETag"), F.concat(F.lit('"'), version, F.lit('"'))),
        ).alias("headers"),
    )


ORACLE = """
WITH visits AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS digest, unnest(range(5)) AS visit FROM pages
), log AS (
  SELECT page_id * 5 + visit AS record_id, url, visit * 1000000 + page_id % 1000 AS "time",
         (visit = 0 AND page_id % 7 <> 0) OR visit = 2 AS whole,
         CASE WHEN visit IN (2, 3) THEN md5(digest || '2') ELSE digest END AS version, visit
  FROM visits
), cut AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS plain FROM log
), parts AS (
  SELECT *, regexp_extract(plain, '^([^?]*)', 1) AS place, regexp_extract(plain, '\\?(.*)$', 1) AS query FROM cut
), keyed AS (
  SELECT *,
    regexp_replace(regexp_replace(lower(regexp_extract(place, '^(?:[^/@]*@)?([^/]*)', 1)), ':(80|443)?$', ''), '^www\\.', '')
    || rtrim(regexp_extract(place, '^[^/]*(/.*)?$', 1), '/')
    || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS url_key
  FROM (
    SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref)(=|$)'))), '&') AS q
    FROM parts
  )
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY url_key, "time", record_id) AS n FROM keyed
), joined AS (
  SELECT r.record_id, r.url_key, r.visit, r.version, r."time", s.record_id AS response_id, s."time" AS response_time,
         s.version AS stored, s.visit AS stored_visit
  FROM (SELECT * FROM ranked WHERE NOT whole) r
  ASOF LEFT JOIN (SELECT * FROM ranked WHERE whole) s ON r.url_key = s.url_key AND r.n > s.n
)
SELECT record_id, url_key,
  CASE WHEN response_id IS NULL THEN 'no earlier response' WHEN version <> stored THEN 'validator mismatch' ELSE 'merged' END AS status,
  response_id, response_time,
  CASE WHEN response_id IS NOT NULL AND version = stored
    THEN 'content-type=text/html;date=' || "time" || ';etag="' || version || '"' END AS headers
FROM joined
"""


@register("op6_revisits", ORACLE)
def op6(spark, sf_dir):
    resolved = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return resolved.withColumn("headers", F.array_join(entries, ";"))
