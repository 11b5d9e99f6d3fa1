"""Resolving not-modified revisits: each finds the latest earlier full response of its canonical URL.

The as-of join runs on distinct (URL, time) points. Times are cut into buckets at global quantiles; within a
bucket of a URL a window carries the last response forward, and the last response of earlier buckets is
carried by a second window of at most ``BUCKETS`` rows. So a URL with a third of all captures is spread over
the buckets. Records then meet their response by an equality join on (URL, time).

A revisit is ``resolved`` if entity tags agree (weak comparison), or, where one side has none, dates of last
modification agree; ``mismatch`` if the compared validators differ; ``unverified`` if there are none to
compare; ``unmatched`` without an earlier response. A resolved revisit gets the response's headers with
the permitted headers of the revisit in their place, and the response's payload digest.

Only responses strictly earlier in time count; of several at one time the one with the largest record id
(nulls smallest) does. Rows without URL or time take no part as responses and stay unmatched as revisits.
Repeated revisits are each answered; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm import common as C
from indicata.llm.url_filter import canonical

#: The headers that a not-modified response may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
BUCKETS = 256


def header(headers: Column, name: str) -> Column:
    """The value of a header by its name in any case, or null."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), 0)["value"]


def merged(stored: Column, update: Column, permitted: tuple[str, ...] = PERMITTED) -> Column:
    """``stored`` with the permitted ones of ``update`` in the place of those of the same name, sorted."""
    allowed = F.filter(update, lambda h: F.lower(h["name"]).isin(*permitted))
    names = F.transform(allowed, lambda h: F.lower(h["name"]))
    kept = F.filter(stored, lambda h: ~F.array_contains(names, F.lower(h["name"])))
    return F.array_sort(F.concat(kept, allowed))


def as_of(points: DataFrame, bounds: list) -> DataFrame:
    """``points`` (url, time, full) with ``found``: the time of the url's latest earlier full point."""
    at = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("time"))) if bounds else F.lit(0)
    rows = points.withColumn("bucket", at).withColumn("hit", F.when(F.col("full"), F.col("time")))
    earlier = Window.unboundedPreceding, -1
    within = Window.partitionBy("url", "bucket").orderBy("time").rowsBetween(*earlier)
    across = Window.partitionBy("url").orderBy("bucket").rowsBetween(*earlier)  # at most BUCKETS rows
    carried = rows.groupBy("url", "bucket").agg(F.max("hit").alias("hit"))
    carried = carried.select("url", "bucket", F.max("hit").over(across).alias("carried"))
    found = rows.withColumn("within", F.max("hit").over(within)).join(carried, ["url", "bucket"])
    return found.select("url", "time", F.coalesce("within", "carried").alias("found"))


def resolve(records: DataFrame, permitted: tuple[str, ...] = PERMITTED) -> DataFrame:
    """One row per revisit of ``records`` (record_id, url, time, status, digest, headers).

    ``headers`` is an array of (name, value). Status 200 is a full response, 304 a revisit.
    """
    known = F.when(F.col("url") != "", F.col("url"))
    rows = records.select("record_id", known.alias("url"), "time", "status", "digest", "headers")
    full = rows.where("status = 200 AND url IS NOT NULL AND time IS NOT NULL")
    responses = full.groupBy("url", "time").agg(F.max(F.struct("record_id", "digest", "headers")).alias("full"))
    revisits = rows.where("status = 304")
    asked = revisits.where("url IS NOT NULL AND time IS NOT NULL")
    points = (
        asked.select("url", "time", F.lit(False).alias("full"))
        .unionByName(full.select("url", "time", F.lit(True).alias("full")))
        .groupBy("url", "time")
        .agg(F.bool_or("full").alias("full"))
    )
    shares = [i / BUCKETS for i in range(1, BUCKETS)]
    bounds = points.agg(F.percentile_approx("time", shares, 10_000)).first()[0] or []
    found = as_of(points, sorted(set(bounds))).where("found IS NOT NULL")
    paired = revisits.join(found, ["url", "time"], "left").join(
        responses.select(F.col("url").alias("_url"), F.col("time").alias("found_time"), "full"),
        (F.col("url") == F.col("_url")) & (F.col("found") == F.col("found_time")),
        "left",
    )
    tag = lambda h: F.regexp_replace(header(h, "etag"), "^W/", "")
    ours, theirs = tag(F.col("headers")), tag(F.col("full.headers"))
    dated, their_date = header(F.col("headers"), "last-modified"), header(F.col("full.headers"), "last-modified")
    equal = F.when(ours.isNotNull() & theirs.isNotNull(), ours == theirs).otherwise(dated == their_date)
    outcome = (
        F.when(F.col("full").isNull(), "unmatched")
        .when(equal.isNull(), "unverified")
        .when(equal, "resolved")
        .otherwise("mismatch")
    )
    done = F.col("outcome") == "resolved"
    return paired.withColumn("outcome", outcome).select(
        "record_id",
        "url",
        "time",
        "outcome",
        F.col("full.record_id").alias("response_id"),
        F.col("found").alias("response_time"),
        F.when(done, F.col("full.digest")).alias("digest"),
        F.when(done, merged(F.col("full.headers"), F.col("headers"), permitted)).alias("headers"),
    )


def _headers(*pairs: tuple[str, Column]) -> Column:
    """An array of (name, value) without the null values."""
    every = F.array(*[F.struct(F.lit(n).alias("name"), v.cast("string").alias("value")) for n, v in pairs])
    return F.filter(every, lambda h: h["value"].isNotNull())


def capture_records(pages: DataFrame) -> DataFrame:
    """Archive records made from pages: a full response each, and a revisit some time later.

    A revisit repeats the page's entity tag, or has another (every 5th page), a weak one (every 7th), or
    only a date (every 3rd of the rest); every 11th has no validator at all.
    """
    page = F.col("page_id")
    digest = F.md5(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    base = pages.select(page, canonical(F.col("url")).alias("url"), digest.alias("digest"))
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    day = F.concat(F.lit("day "), (page % 30).cast("string"))
    tagged = F.when(page % 11 == 0, None).when(page % 5 == 0, '"changed"')
    tagged = tagged.when(page % 7 == 0, F.concat(F.lit("W/"), tag)).when(page % 3 != 0, tag)
    response = base.select(
        (page * 2).alias("record_id"),
        "url",
        (page * 60).alias("time"),
        F.lit(200).alias("status"),
        "digest",
        _headers(
            ("Content-Type", F.lit("text/html")),
            ("ETag", tag),
            ("Last-Modified", day),
            ("Date", page * 60),
            ("Cache-Control", F.lit("max-age=60")),
        ).alias("headers"),
    )
    revisit = base.select(
        (page * 2 + 1).alias("record_id"),
        "url",
        (page * 60 + 1 + page % 97 * 3600).alias("time"),
        F.lit(304).alias("status"),
        F.lit(None).cast("string").alias("digest"),
        _headers(
            ("Content-Type", F.lit("text/plain")),
            ("etag", tagged),
            ("Last-Modified", F.when(page % 11 != 0, day)),
            ("Date", page * 60 + 1 + page % 97 * 3600),
            ("X-Cache", F.lit("HIT")),
        ).alias("headers"),
    )
    return response.unionByName(revisit)


def op3_warc_revisit(spark, sf_dir: str) -> DataFrame:
    """Every revisit of the records made from all pages, with what it resolves to."""
    records = C.cut(capture_records(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    line = F.transform(F.col("headers"), lambda h: F.concat(h["name"], F.lit(": "), h["value"]))
    return resolve(records).withColumn("headers", F.array_join(line, "\n"))


OP3_SQL = r"""
WITH parts AS (
  SELECT page_id, md5(coalesce(html, '')) AS digest,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    list_sort(list_filter(string_split(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), ''), '&'),
      lambda x: x <> '' AND NOT starts_with(x, 'utm_'))) AS q
  FROM pages
), base AS (
  SELECT page_id, digest, '"' || substr(digest, 1, 16) || '"' AS tag, 'day ' || (page_id % 30) AS day,
    CASE WHEN regexp_replace(host, '^(www|m)\.', '') <> '' THEN
      regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(/|\.html)$', '')
        || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS url
  FROM parts
), full_ AS (
  SELECT page_id * 2 AS record_id, url, page_id * 60 AS time, tag, day, digest FROM base WHERE url IS NOT NULL
), latest AS (
  SELECT * FROM full_ QUALIFY row_number() OVER (PARTITION BY url, time ORDER BY record_id DESC) = 1
), revisits AS (
  SELECT page_id * 2 + 1 AS record_id, url, page_id * 60 + 1 + page_id % 97 * 3600 AS time,
    CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 5 = 0 THEN '"changed"' WHEN page_id % 7 = 0 THEN 'W/' || tag
      WHEN page_id % 3 <> 0 THEN tag END AS etag,
    CASE WHEN page_id % 11 <> 0 THEN day END AS modified
  FROM base
), found AS (
  SELECT r.*, f.record_id AS response_id, f.time AS response_time, f.tag, f.day, f.digest
  FROM revisits r LEFT JOIN latest f ON f.url = r.url
    AND f.time = (SELECT max(g.time) FROM latest g WHERE g.url = r.url AND g.time < r.time)
), judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'unmatched'
    WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = tag THEN 'resolved' ELSE 'mismatch' END
    WHEN modified IS NOT NULL THEN CASE WHEN modified = day THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unverified' END AS outcome
  FROM found
)
SELECT record_id, url, time, outcome, response_id, response_time,
  CASE WHEN outcome = 'resolved' THEN digest END AS digest,
  CASE WHEN outcome = 'resolved' THEN 'Cache-Control: max-age=60' || chr(10) || 'Content-Type: text/html' || chr(10)
    || 'Date: ' || time || chr(10) || CASE WHEN etag IS NULL THEN 'ETag: ' || tag || chr(10) ELSE '' END
    || 'Last-Modified: ' || modified
    || CASE WHEN etag IS NOT NULL THEN chr(10) || 'etag: ' || etag ELSE '' END END AS headers
FROM judged
"""
