"""WARC: resolves not-modified revisits to the full responses they stand for.

A revisit (a 304 answer) has no body. Its body is that of the latest earlier
full response of the same canonical URL: an as-of join on (URL, time). The
validators of both are then checked, and the response's headers are merged
with those that a 304 may carry.

The as-of join has no unbounded group. Time is cut into buckets of equally
many captures; inside a (URL, bucket) group a running last value finds the
latest response, and across buckets one row per (URL, bucket) carries the
latest response onwards. A URL with a third of all captures is spread over
all buckets. Only keys and times take part; headers are joined by record.

Status of a revisit: ``resolved`` (a validator that both have agrees),
``mismatch`` (the strongest validator that both have differs), ``unverified``
(they share none), ``no_response`` (no earlier full response).

Defined cases: earlier means strictly earlier; of responses at the same time
the largest record wins; a record without URL (null or blank) or time is never
matched; a URL without ``scheme://`` matches only the same spelling; rows
repeated with the same record come back once each; null headers are empty; an
empty table gives an empty result; other columns never take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import table

#: Time buckets of the as-of join, and the precision of their bounds.
BUCKETS, ACCURACY = 256, 10_000
# Headers that a 304 answer may update, tracking parameters, default ports.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
_TRACKING = r"(utm_[a-z]+|ref|gclid|fbclid|session|sid)"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, http for https, without default port, user, fragment, tracking
    parameters, index page or trailing slash; parameters in order. Without ``scheme://`` the trimmed URL
    itself, null if empty."""
    own = F.trim(url)
    u = F.regexp_replace(own, "#.*$", "")
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(host, r":(80|443)$", "")
    path = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r"/index\.html?$", "/"), r"/+$", "")
    params = F.array_sort(F.filter(F.split(F.regexp_extract(u, r"\?(.*)$", 1), "&"),
                                   lambda p: (p != "") & ~p.rlike(f"^{_TRACKING}(=|$)")))
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.when(own.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.concat(F.lit("http://"), host, path, query)).when(
        own != "", own)


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def latest_response(records: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``record_id`` of each revisit with the ``response_id`` of the latest earlier full response, if any.

    ``records`` has record_id, curl (canonical URL), ts (long), kind."""
    rows = records.select("record_id", "curl", "ts", "kind").filter("curl IS NOT NULL AND ts IS NOT NULL")
    shares = [k / buckets for k in range(1, buckets)]
    cuts = rows.agg(F.percentile_approx("ts", shares, ACCURACY)).first()[0] if shares else None
    cuts = sorted(set(cuts or ()))
    bounds = F.array(*[F.lit(int(c)) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    # number of bounds at or below the time: all captures of one time share a bucket
    rows = rows.withColumn("bucket", F.size(F.filter(bounds, lambda c: c <= F.col("ts"))))
    response = F.when(F.col("kind") == "response", F.struct("ts", "record_id"))
    earlier = Window.partitionBy("curl", "bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("here", F.max(response).over(earlier)).filter("kind = 'revisit'")
    per_bucket = rows.groupBy("curl", "bucket").agg(F.max(response).alias("last"))
    before = Window.partitionBy("curl").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.withColumn("carried", F.max("last").over(before)).select("curl", "bucket", "carried")
    return inside.join(carried, ["curl", "bucket"], "left").select(
        "record_id", F.coalesce("here", "carried")["record_id"].alias("response_id"))


def resolve(records: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row per revisit: canonical URL, time, status, response, merged headers, digest of the body.

    ``records`` has record_id, url, ts (long), kind (``response`` or ``revisit``), etag, last_modified,
    digest and headers (map)."""
    rows = records.withColumn("curl", canonical_url(F.col("url")))
    found = latest_response(rows, buckets).filter("response_id IS NOT NULL").distinct()
    empty = F.create_map().cast("map<string,string>")
    revisits = rows.filter("kind = 'revisit'").select(
        "record_id", "curl", "ts", F.col("etag").alias("r_etag"), F.col("last_modified").alias("r_modified"),
        F.col("digest").alias("r_digest"), F.coalesce("headers", empty).alias("r_headers"))
    full = rows.filter("kind = 'response'").select(
        F.col("record_id").alias("response_id"), "etag", "last_modified", "digest",
        F.coalesce("headers", empty).alias("headers")).dropDuplicates(["response_id"])
    # revisits without a response have no key to be dealt by, so they don't go through the second join
    matched = revisits.join(found, "record_id").join(full, "response_id")
    both = matched.unionByName(revisits.join(found, "record_id", "left_anti"), allowMissingColumns=True)
    agrees = F.coalesce(_strong(F.col("etag")) == _strong(F.col("r_etag")),
                        F.col("last_modified") == F.col("r_modified"), F.col("digest") == F.col("r_digest"))
    status = (F.when(F.col("response_id").isNull(), "no_response").when(agrees, "resolved")
              .when(~agrees, "mismatch").otherwise("unverified"))
    allowed = F.map_filter("r_headers", lambda k, v: F.lower(k).isin(*PERMITTED))
    base = F.map_filter("headers", lambda k, v: ~F.array_contains(
        F.transform(F.map_keys(allowed), F.lower), F.lower(k)))
    merged = F.when(status == "resolved", F.map_concat(base, allowed))
    return both.select("record_id", F.col("curl").alias("canonical_url"), "ts", status.alias("status"),
                       "response_id", merged.alias("headers"),
                       F.when(status == "resolved", F.col("digest")).alias("digest"))


def captures(pages: DataFrame) -> DataFrame:
    """A capture history derived from the pages: every page is a full response, and its URL is asked for
    again a day later and an hour earlier by other spellings of the URL. Some validators are weak, stale or
    missing."""
    p = F.col("page_id")
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    modified = F.concat(F.lit("day "), F.pmod(p, F.lit(97)).cast("string"))
    ts = F.lit(1_700_000_000) + F.pmod(p * 7919, F.lit(1_000_003)) * 60
    etag = F.when(F.pmod(p, F.lit(5)) != 0, F.substring(digest, 1, 16))
    base = pages.select("page_id", "url", digest.alias("digest"), modified.alias("modified"), ts.alias("t0"),
                        etag.alias("tag"), F.octet_length(F.coalesce("html", F.lit(""))).alias("n"))
    stale = F.when(F.pmod(p, F.lit(7)) == 3, F.concat(F.lit("old-"), "tag")).otherwise(F.col("tag"))
    full = base.select(
        (p * 3).alias("record_id"), "url", F.col("t0").alias("ts"), F.lit("response").alias("kind"),
        F.col("tag").alias("etag"), F.col("modified").alias("last_modified"), "digest",
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.col("n").cast("string"),
                     F.lit("Date"), F.col("t0").cast("string")).alias("headers"))
    again = []
    for k, wait, spelled in ((1, 86_400, F.regexp_replace("url", "^http:", "https:")),
                             (2, -3_600, F.concat(F.col("url"), F.lit("#again")))):
        when = F.col("t0") + wait
        again.append(base.select(
            (p * 3 + k).alias("record_id"), spelled.alias("url"), when.alias("ts"), F.lit("revisit").alias("kind"),
            F.concat(F.lit("W/"), stale).alias("etag"), F.when(F.pmod(p, F.lit(10)) != 0, F.col("modified"))
            .alias("last_modified"), F.lit(None).cast("string").alias("digest"),
            F.create_map(F.lit("date"), when.cast("string"), F.lit("Cache-Control"), F.lit("max-age=60"),
                         F.lit("Content-Length"), F.lit("0")).alias("headers")))
    return full.union(again[0]).union(again[1])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = resolve(captures(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return got.select("record_id", "canonical_url", "ts", "status", "response_id",
                      F.array_join(lines, "; ").alias("headers"), "digest")


ORACLE = r"""
WITH p AS (
  SELECT page_id, url, sha256(coalesce(html, '')) AS digest, 'day ' || (page_id % 97) AS modified,
         1700000000 + (page_id * 7919 % 1000003) * 60 AS t0, strlen(coalesce(html, '')) AS n
  FROM pages),
tagged AS (SELECT *, CASE WHEN page_id % 5 <> 0 THEN left(digest, 16) END AS tag FROM p),
parts AS (
  SELECT *, regexp_replace(trim(url), '#.*$', '') AS u FROM tagged),
split AS (
  SELECT *, regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)', 1)), ':(80|443)$', '') AS host,
         regexp_replace(regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/index\.html?$', '/'), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid|session|sid)(=|$)'))) AS params
  FROM parts),
c AS (
  SELECT *, 'http://' || host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS curl
  FROM split),
revisit AS (
  SELECT page_id * 3 + k AS record_id, curl, t0 + wait AS ts, modified, page_id,
         CASE WHEN page_id % 7 = 3 THEN 'old-' || tag ELSE tag END AS r_tag,
         CASE WHEN page_id % 10 <> 0 THEN modified END AS r_modified
  FROM c, (VALUES (1, 86400), (2, -3600)) AS v(k, wait)),
best AS (
  SELECT r.record_id, max({'t': f.t0, 'id': f.page_id}) AS hit
  FROM revisit r JOIN c f ON f.curl = r.curl AND f.t0 < r.ts GROUP BY r.record_id),
joined AS (
  SELECT r.*, b.hit.id * 3 AS response_id, f.digest, f.n,
         CASE WHEN b.hit IS NULL THEN 'no_response'
              WHEN f.tag IS NOT NULL AND r.r_tag IS NOT NULL THEN CASE WHEN f.tag = r.r_tag THEN 'resolved' ELSE 'mismatch' END
              WHEN r.r_modified IS NOT NULL THEN CASE WHEN f.modified = r.r_modified THEN 'resolved' ELSE 'mismatch' END
              ELSE 'unverified' END AS status
  FROM revisit r LEFT JOIN best b ON b.record_id = r.record_id LEFT JOIN c f ON f.page_id = b.hit.id)
SELECT record_id, curl AS canonical_url, ts, status, response_id,
       CASE WHEN status = 'resolved' THEN 'Cache-Control: max-age=60; Content-Length: ' || n || '; Content-Type: text/html; date: ' || ts END AS headers,
       CASE WHEN status = 'resolved' THEN digest END AS digest
FROM joined
"""
