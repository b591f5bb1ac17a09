r"""WARC: not-modified revisits resolved to the full response they stand for.

A revisit says that a page was unchanged. It is matched as-of by canonical URL to the latest response captured before
it; the response stands if a validator agrees: the entity tag if the revisit has one (a weak mark W/ does not count),
else Last-Modified, else the payload digest. The merged record has the response's headers, with those that a
not-modified answer may update (:data:`UPDATES`) taken from the revisit.

The join sorts all captures by URL and time into ranges, so the captures of one URL, however many, are spread over
ranges by time. In a range the latest earlier response comes from a window; from earlier ranges of the same URL only
their latest response is carried over, one row per URL and range. Captures of one URL at the same instant stay
together and do not see each other.

``outcome`` is ``resolved``, ``changed`` (a validator differs), ``unverified`` (no validator on either side) or
``missing`` (no earlier response; so too for a null URL or time). Of responses at one instant the greatest id
counts. Null headers count as none; repeated revisits give repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.session import scratch

#: Headers that a not-modified answer updates.
UPDATES = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that do not change a page.
TRACKING = r"^(?:utm_[a-z]+|ref|gclid|fbclid|sessionid|phpsessid|jsessionid)(?:=|$)"

RECORD = "record_id, kind, url, captured_at, headers, digest"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www and default port, path without a last slash, query sorted and without tracking.

    Scheme, user and fragment are left out.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), "^.*@", "")
    host = F.regexp_replace(F.regexp_replace(host, ":(?:80|443)$", ""), "^www[0-9]*\\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    parts = F.split(F.regexp_extract(bare, "^[^?]*\\?(.*)$", 1), "&")
    query = F.array_join(F.array_sort(F.filter(parts, lambda p: (p != "") & ~F.lower(p).rlike(TRACKING))), "&")
    return F.when(url.isNotNull(), F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _same_tag(a: Column, b: Column) -> Column:
    return F.regexp_replace(a, "^W/", "") == F.regexp_replace(b, "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every revisit of ``records`` (record_id, kind, url, captured_at as a number, headers, digest).

    ``kind`` is ``response`` or ``revisit``; headers are a map with names in lower case. Returns record_id,
    canonical_url, captured_at, target_id, outcome, headers.
    """
    spark = records.sparkSession
    path = scratch(spark, "captures")
    none = F.expr("cast(map() as map<string,string>)")
    captures = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", "kind", canonical_url(F.col("url")).alias("canonical_url"), "captured_at",
        F.coalesce("headers", none).alias("headers"), "digest",
    )
    usable = F.col("canonical_url").isNotNull() & F.col("captured_at").isNotNull()
    ranges = captures.where(usable).repartitionByRange("canonical_url", "captured_at")
    ranges.withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranges = spark.read.parquet(path)

    response = F.when(
        F.col("kind") == "response",
        F.struct("captured_at", "record_id", "digest", F.map_entries("headers").alias("entries")),
    )
    # times are numbers of any kind, so what is earlier is told by their order, not by a distance
    by_url = Window.partitionBy("part", "canonical_url")
    ranges = ranges.withColumn("moment", F.dense_rank().over(by_url.orderBy("captured_at")))
    before = by_url.orderBy("moment").rangeBetween(Window.unboundedPreceding, -1)
    near = ranges.withColumn("near", F.max(response).over(before)).where("kind = 'revisit'")
    ends = ranges.groupBy("canonical_url", "part").agg(F.max(response).alias("latest"))
    # one row per URL and range
    earlier = Window.partitionBy("canonical_url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("canonical_url", "part", F.max("latest").over(earlier).alias("carried"))
    placed = near.join(carried, ["canonical_url", "part"], "left").withColumn("target", F.coalesce("near", "carried"))
    unplaced = captures.where(~usable & (F.col("kind") == "revisit"))
    placed = placed.unionByName(unplaced, allowMissingColumns=True)

    stored = F.map_from_entries("target.entries")
    own, theirs = F.col("headers"), stored
    tag, date = F.try_element_at(own, F.lit("etag")), F.try_element_at(own, F.lit("last-modified"))
    agrees = (
        F.when(tag.isNotNull(), F.coalesce(_same_tag(tag, F.try_element_at(theirs, F.lit("etag"))), F.lit(False)))
        .when(date.isNotNull(), F.coalesce(date == F.try_element_at(theirs, F.lit("last-modified")), F.lit(False)))
        .when(F.col("digest").isNotNull() & F.col("target.digest").isNotNull(), F.col("digest") == F.col("target.digest"))
    )
    outcome = (
        F.when(F.col("target").isNull(), "missing")
        .when(agrees.isNull(), "unverified")
        .when(agrees, "resolved")
        .otherwise("changed")
    )
    updates = F.map_filter(own, lambda name, _: name.isin(*UPDATES))
    merged = F.map_zip_with(theirs, updates, lambda _, old, new: F.coalesce(new, old))
    return placed.withColumn("outcome", outcome).select(
        "record_id",
        "canonical_url",
        "captured_at",
        F.when(F.col("outcome") == "resolved", F.col("target.record_id")).alias("target_id"),
        "outcome",
        F.when(F.col("outcome") == "resolved", merged).alias("headers"),
    )


def header_lines(headers: Column) -> Column:
    """``name: value`` lines in the order of names; null for null headers."""
    entries = F.array_sort(F.map_entries(headers))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def page_records(pages: DataFrame) -> DataFrame:
    """Captures of a page table: every page is asked for four times, at ten ticks a page.

    Five ticks early there is only a revisit. Then comes the full response, and three and seven ticks later a revisit
    with a weak entity tag and one with a date, which is another date for pages of an odd length.
    """
    tick = F.col("page_id") * 10
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    day = F.concat(F.lit("day "), (F.col("page_id") % 365).cast("string"))
    other = F.when(F.length("html") % 2 == 0, day).otherwise("day x")

    def headers(**values) -> Column:
        pairs = [x for k, v in values.items() for x in (F.lit(k.replace("_", "-")), v if isinstance(v, Column) else F.lit(v))]
        return F.create_map(*pairs)

    def record(number: int, kind: str, shift: int, heads: Column) -> Column:
        return F.struct(
            (F.col("page_id") * 4 + number).alias("record_id"), F.lit(kind).alias("kind"), F.col("url"),
            (tick + shift).alias("captured_at"), heads.alias("headers"), F.md5("html").alias("digest"),
        )

    size = F.length("html").cast("string")
    full = headers(cache_control="max-age=60", content_length=size, content_type="text/html", date=tick.cast("string"), etag=tag, last_modified=day)

    def short(shift: int, **more) -> Column:
        return headers(cache_control="no-cache", content_length="0", date=(tick + shift).cast("string"), **more)

    rows = F.array(
        record(0, "revisit", -5, short(-5, etag=tag)),
        record(1, "response", 0, full),
        record(2, "revisit", 3, short(3, etag=F.concat(F.lit("W/"), tag))),
        record(3, "revisit", 7, short(7, last_modified=other)),
    )
    return pages.where("page_id IS NOT NULL").select(F.explode(rows).alias("r")).select("r.*")


#: The same over ``pages``, with the texts of headers written out.
ORACLE = r"""
WITH p AS (SELECT page_id, url, '"' || md5(html) || '"' AS tag, 'day ' || (page_id % 365) AS day, length(html) AS size,
    html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
q AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^.*@', ''), ':(80|443)$', ''), '^www[0-9]*\.', '')
    || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*\?(.*)$', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|ref|gclid|fbclid|sessionid|phpsessid|jsessionid)(=|$)'))), '&') AS query FROM p),
c AS (SELECT *, place || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical_url FROM q),
v AS (SELECT page_id * 4 + n AS record_id, canonical_url, page_id * 10 + s AS captured_at, n, tag, day, size FROM c,
    (VALUES (0, -5), (2, 3), (3, 7)) x(n, s)),
j AS (SELECT v.*, max({'at': r.page_id * 10, 'id': r.page_id}) AS t FROM v
    LEFT JOIN c r ON r.canonical_url = v.canonical_url AND r.page_id * 10 < v.captured_at GROUP BY ALL),
k AS (SELECT j.*, r.tag AS rtag, r.day AS rday, r.size AS rsize, r.page_id AS rid FROM j LEFT JOIN c r ON r.page_id = t.id),
d AS (SELECT *, FALSE AS dated FROM k WHERE n <> 3 UNION ALL SELECT *, TRUE FROM k WHERE n = 3)
SELECT record_id, canonical_url, captured_at, CASE WHEN outcome = 'resolved' THEN rid * 4 + 1 END AS target_id, outcome,
  CASE WHEN outcome = 'resolved' THEN 'cache-control: no-cache' || chr(10) || 'content-length: ' || rsize || chr(10) ||
    'content-type: text/html' || chr(10) || 'date: ' || captured_at || chr(10) ||
    'etag: ' || CASE n WHEN 0 THEN tag WHEN 2 THEN 'W/' || tag ELSE rtag END || chr(10) ||
    'last-modified: ' || rday END AS headers
FROM (SELECT *, CASE WHEN rid IS NULL THEN 'missing' WHEN dated THEN
    CASE WHEN size % 2 = 0 AND day = rday THEN 'resolved' ELSE 'changed' END
    WHEN tag = rtag THEN 'resolved' ELSE 'changed' END AS outcome FROM d)
"""
