"""Operator 10, WARC: resolution of not-modified revisits.

A ``revisit`` record says that a URL was fetched and the server answered 304
Not Modified; it has no payload of its own.  It is resolved by an as-of join to
the latest earlier full response of the same canonical URL.  The validators
(entity tag, then last-modified time) must agree: if the revisit names one and
the response's differs, the revisit stays unresolved with a reason; the time is
not asked where both have entity tags.  The resolved
record takes the response's payload and headers, updated by the headers that a
304 may carry.

The as-of join is one running maximum over the rows of a URL in time order.
Rows are dealt out by (URL, minute): a running maximum inside each minute, then the
largest earlier response of the day's minutes before and of the days before, from one
pre-aggregated row per minute and per day.  So a URL with a third of all rows is spread
over many tasks, also where they fall on one day.

Records: ``record_id, url, fetched_at, kind`` (``response`` or ``revisit``),
``etag``, ``last_modified``, ``headers`` (a map of lower-case names) and
``payload_digest``; other columns pass through.

Ties: of responses at one time the one of larger record id counts; a response at
the very time of the revisit is earlier if its record id is not larger.  Nulls: a
null URL, time or record id cannot be joined; such a revisit is unresolved
(``no url or time``).  A null validator is not checked; null headers are empty.  Of header
names that differ in case only, the one last in byte order counts where a 304 updates the stored ones.
Repeated rows each keep their row; an empty table gives no row; values of any length pass.
Of the input's columns only those of the result's names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 60          # time bucket of the as-of join
BUCKETS = 1440               # buckets of the next larger one

# Header fields that a 304 answer may carry and that update the stored ones.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")

# Query parameters that do not change a page.
TRACKING = r"(utm_[a-z]+|fbclid|gclid)=[^&]*"

# The scheme of a URL, and the host of what follows it.
SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"
HOST = r"^[^/?]*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical_url(url: Column) -> Column:
    """ASCII lower-case scheme, ``http`` for ``https`` or none, and host without ``www.``
    and without its scheme's default port, no fragment, no tracking parameters, no
    trailing slash."""
    u = F.regexp_replace(url, r"#.*$", "")
    scheme = F.translate(F.regexp_extract(u, SCHEME, 1), UPPER, LOWER)
    rest = F.regexp_replace(u, SCHEME, "")
    host = F.regexp_replace(F.translate(F.regexp_extract(rest, HOST, 0), UPPER, LOWER), r"^www\.", "")
    host = (F.when(scheme == "https", F.regexp_replace(host, ":443$", ""))
            .when(scheme.isin("", "http"), F.regexp_replace(host, ":80$", "")).otherwise(host))
    tail = F.regexp_replace(rest, HOST, "")
    path = F.regexp_replace(F.regexp_extract(tail, r"^[^?]*", 0), r"/+$", "")
    query = F.regexp_replace(F.regexp_replace(tail, r"^[^?]*\??", ""), r"(^|&)" + TRACKING, "")
    query = F.regexp_replace(query, r"^&", "")
    return F.concat(F.when(scheme.isin("", "https"), "http").otherwise(scheme), F.lit("://"), host, path,
                    F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _lower_names(headers: Column) -> Column:
    """Headers by lower-case name; of equal names the one spelt last in byte order
    (a map has no order of its own)."""
    entries = F.array_sort(F.map_entries(headers))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(
        F.filter(entries, lambda e: F.lower(e["key"]) == n), -1)["value"]))


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``records`` with ``canonical_url, resolution, refers_to, resolved_digest,
    resolved_headers``.  ``resolution``: ``full`` (a response), ``resolved``,
    ``no url or time``, ``no earlier response``, ``etag differs``,
    ``last-modified differs``."""
    made = ("canonical_url", "resolution", "refers_to", "resolved_digest", "resolved_headers")
    cols = [F.col(f"`{c}`") for c in records.columns if c.lower() not in made]
    own = "_w"
    while any(c.lower().startswith(own) for c in records.columns):
        own += "_"
    key, small, big, spot, last, carry, near, day, found = (own + x for x in (
        "key", "small", "big", "spot", "last", "carry", "near", "day", "from"))
    at = F.col("fetched_at")
    usable = F.col("url").isNotNull() & at.isNotNull() & F.col("record_id").isNotNull()
    full = F.col("kind") == "response"
    none = F.create_map().cast("map<string,string>")
    is_spot = F.struct(at.alias("at"), F.col("record_id").alias("record_id"), F.col("payload_digest").alias("digest"),
                       F.col("etag").alias("etag"), F.col("last_modified").alias("last_modified"),
                       F.to_json(F.coalesce("headers", none)).alias("headers"))
    r = (records.select(*cols, canonical_url(F.col("url")).alias("canonical_url"))
         .withColumn(small, F.floor(F.unix_seconds(at) / bucket_seconds))
         .withColumn(big, F.floor(F.col(small) / BUCKETS))
         .withColumn(spot, F.when(full & usable, is_spot))
         .withColumn(key, F.when(usable, F.col("canonical_url"))))
    # Rows that cannot be joined are spread by their content instead of meeting in one group.
    loose, tied = r.where(F.col(key).isNull()), r.where(F.col(key).isNotNull())
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    ends = tied.groupBy(key, big, small).agg(F.max(spot).alias(last))
    days = ends.groupBy(key, big).agg(F.max(last).alias(last))
    days = days.select(key, big, F.max(last).over(before(Window.partitionBy(key).orderBy(big))).alias(day))
    ends = ends.select(key, big, small, F.max(last).over(
        before(Window.partitionBy(key, big).orderBy(small))).alias(carry)).join(days, [key, big])
    inside = before(Window.partitionBy(key, big, small).orderBy("fetched_at", "record_id", "kind"))
    tied = (tied.withColumn(near, F.max(spot).over(inside)).join(ends, [key, big, small])
            .withColumn(found, F.coalesce(near, carry, day)).drop(near, carry, day))
    both = tied.unionByName(loose.withColumn(found, F.lit(None).cast(r.schema[spot].dataType)))
    f = F.col(found)
    resolution = (F.when(full, "full")
                  .when(~usable | F.col("canonical_url").isNull(), "no url or time")
                  .when(f.isNull(), "no earlier response")
                  .when(F.col("etag") != f["etag"], "etag differs")
                  .when((F.col("etag").isNull() | f["etag"].isNull())
                        & (F.col("last_modified") != f["last_modified"]), "last-modified differs")
                  .otherwise("resolved"))
    headers = F.coalesce("headers", none)
    sent = F.map_filter(_lower_names(headers), lambda k, _: k.isin(*PERMITTED))
    stored = F.from_json(f["headers"], "map<string,string>")
    stored = F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(sent), F.lower(k)))
    ok = F.col("resolution") == "resolved"
    return (both.withColumn("resolution", resolution)
            .withColumn("refers_to", F.when(ok, f["record_id"]))
            .withColumn("resolved_digest", F.when(F.col("resolution") == "full", F.col("payload_digest"))
                        .when(ok, f["digest"]))
            .withColumn("resolved_headers", F.when(F.col("resolution") == "full", headers)
                        .when(ok, F.map_concat(stored, sent)))
            .drop(small, big, spot, key, found))


# ---- records derived from the pages table for the registered query ----

DAY = 86_400
START = 1_700_000_000      # first fetch, seconds


def records_from_pages(pages: DataFrame) -> DataFrame:
    """WARC records from ``pages(page_id, url, html)``: every page is a full
    response at a time that follows from its id, and is revisited by 304 answers
    zero to three times later.  Some revisits carry a changed entity tag, some
    only a last-modified time, some neither.  Payloads stay behind: a record
    carries the SHA-256 of its page."""
    p = F.col("page_id")
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    base = pages.select(
        "page_id", "url", digest.alias("digest"),
        (F.lit(START) + F.pmod(p * 7919, F.lit(30 * DAY))).alias("t"))
    base = base.withColumn("tag", F.substring("digest", 1, 16))
    n = F.pmod(p, F.lit(4))
    each = base.withColumn("visit", F.explode(F.sequence(F.lit(0).cast("bigint"), n.cast("bigint"))))
    v, first = F.col("visit"), F.col("visit") == 0
    kind = F.pmod(p + v, F.lit(5))
    at = F.col("t") + v * (3 * DAY + F.pmod(p, F.lit(977)))
    etag = (F.when(first, F.col("tag")).when(kind == 1, F.concat("tag", F.lit("x")))
            .when(kind.isin(2, 3), F.lit(None).cast("string")).otherwise(F.col("tag")))
    modified = F.when(first | (kind == 2), F.timestamp_seconds(F.col("t") - DAY))
    headers = F.when(first, F.create_map(
        F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.lit("1"),
        F.lit("etag"), etag, F.lit("date"), at.cast("string"))).otherwise(F.create_map(
            F.lit("date"), at.cast("string"), F.lit("content-length"), F.lit("0"),
            F.lit("cache-control"), F.concat(F.lit("max-age="), v.cast("string"))))
    return each.select(
        (p * 4 + v).alias("record_id"), "url", F.timestamp_seconds(at).alias("fetched_at"),
        F.when(first, "response").otherwise("revisit").alias("kind"), etag.alias("etag"),
        modified.alias("last_modified"), headers.alias("headers"),
        F.when(first, F.col("digest")).alias("payload_digest"))
