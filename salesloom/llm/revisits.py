"""Resolution of not-modified revisits in web archives (operator 6).

A revisit record says that a server answered "not modified"; its payload is that of an earlier
full response. Each revisit is joined, as of its time, to the latest earlier response with the
same canonical URL. If their validators agree, the revisit gets that response's payload reference
and its headers, overlaid with those headers that a not-modified answer may change.

The join is a running maximum in time order. A hot URL is split: time is cut into slices at
quantiles, each (URL, slice) is ordered on its own, and the latest response of the slices
before is carried into it, of which there is one row per URL and slice. Payloads are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

# Rows per time slice, and the most slices.
SLICE_ROWS = 1_000_000
SLICES = 1024

# Header fields that a 304 answer carries for the cache to update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")

FOUND = ("resolved", "mismatch", "unverified", "orphan")


def canonical(url: Column) -> Column:
    """The URL as a key: no scheme, user, "www.", default port, fragment or trailing slash;
    host in lower case; parameters sorted, without campaign marks. NULL is ''."""
    text = F.trim(F.coalesce(url.cast("string"), F.lit("")))
    text = F.regexp_replace(text, "#.*", "")
    text = F.regexp_replace(text, r"\A[A-Za-z][A-Za-z0-9+.-]*://", "")
    place = F.regexp_extract(text, r"\A([^?]*)", 1)
    query = F.regexp_extract(text, r"\?(.*)", 1)
    host = F.lower(F.regexp_extract(place, r"\A([^/]*)", 1))
    host = F.regexp_replace(host, r"\A[^@]*@", "")
    host = F.regexp_replace(F.regexp_replace(host, r":(?:80|443)\z", ""), r"\Awww\.", "")
    path = F.regexp_replace(F.regexp_extract(place, r"\A[^/]*(/.*)", 1), r"/+\z", "")
    parameters = F.array_sort(F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"\A(?:utm_[a-z]+|ref)=")
    ))
    return F.concat(host, path, F.when(
        F.size(parameters) > 0, F.concat(F.lit("?"), F.array_join(parameters, "&"))
    ).otherwise(""))


def _fields(headers: Column) -> Column:
    """Header entries with lower-case names, sorted; the last of equal names wins."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(
        F.lower(e["key"]).alias("key"), e["value"].alias("value")
    ))
    return F.array_sort(F.coalesce(entries, F.array().cast("array<struct<key:string,value:string>>")))


def merged(response: Column, revisit: Column) -> Column:
    """The response's fields, with the permitted ones of the revisit in their place."""
    changed = F.filter(revisit, lambda e: e["key"].isin(*PERMITTED))
    kept = F.filter(response, lambda e: ~F.exists(changed, lambda c: c["key"] == e["key"]))
    return F.array_sort(F.concat(kept, changed))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, r"\AW/", "")


def _verdict(has: Column, ref: Column) -> Column:
    """Entity tags decide if both sides have one, else modification dates, else digests."""
    def agree(mine: Column, theirs: Column, rest: Column) -> Column:
        both = mine.isNotNull() & theirs.isNotNull()
        return F.when(both, F.when(mine == theirs, FOUND[0]).otherwise(FOUND[1])).otherwise(rest)

    digest = agree(F.col("digest"), ref["digest"], F.lit(FOUND[2]))
    modified = agree(F.col("last_modified"), ref["last_modified"], digest)
    return F.when(has, agree(_weak(F.col("etag")), _weak(ref["etag"]), modified)).otherwise(FOUND[3])


def resolve(records: DataFrame) -> DataFrame:
    """Every revisit with what it refers to.

    ``records``: record_id (long), url, at (long), kind ("response" or "revisit"), etag,
    last_modified, digest (strings), headers (map of strings). Result: record_id, url_key, at,
    status, ref_id, ref_at, fields (array of struct<key, value>).

    Status: resolved; mismatch (the latest earlier response has other validators); unverified
    (no validator on both sides); orphan (no earlier response). Only resolved revisits have a
    reference and merged fields; the others keep their own fields. "Earlier" is strictly so;
    of responses at one time the largest record_id counts. A record whose time is NULL
    is never referred to and, as a revisit, is an orphan. Repeated rows are repeated in the
    result; other kinds and other columns are not read.
    """
    rows = records.where(F.col("kind").isin("response", "revisit")).select(
        F.col("record_id").cast("long").alias("record_id"), canonical(F.col("url")).alias("url_key"),
        F.col("at").cast("long").alias("at"), "kind", "etag", "last_modified", "digest",
        _fields(F.col("headers")).alias("fields"),
    )
    size = rows.agg(F.count("at").alias("n")).first()["n"]
    n = min(SLICES, 1 + size // SLICE_ROWS)
    cuts = []
    if n > 1:
        at = [k / n for k in range(1, n)]
        cuts = sorted(set(rows.agg(F.percentile_approx("at", at, 10 * n)).first()[0]))
    slice_ = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("at"))) if cuts else F.lit(0)
    response = F.when((F.col("kind") == "response") & F.col("at").isNotNull(), F.struct(
        "at", "record_id", "etag", "last_modified", "digest", "fields"
    ))
    timed = rows.withColumn("slice", slice_).withColumn("response", response)

    before = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = timed.groupBy("url_key", "slice").agg(F.max("response").alias("latest")).select(
        "url_key", "slice", F.max("latest").over(before).alias("carried")
    ) if cuts else None
    earlier = Window.partitionBy("url_key", "slice").orderBy("at").rangeBetween(
        Window.unboundedPreceding, -1
    )
    latest = timed.withColumn("within", F.max("response").over(earlier)).where("kind = 'revisit'")
    ref = F.col("within")
    if carried is not None:
        latest = latest.join(carried, ["url_key", "slice"])
        ref = F.coalesce("within", "carried")
    judged = latest.withColumn("ref", F.when(F.col("at").isNotNull(), ref)).withColumn(
        "status", _verdict(F.col("ref").isNotNull(), F.col("ref"))
    )
    resolved = F.col("status") == FOUND[0]
    return judged.select(
        "record_id", "url_key", "at", "status",
        F.when(resolved, F.col("ref.record_id")).alias("ref_id"),
        F.when(resolved, F.col("ref.at")).alias("ref_at"),
        F.when(resolved, merged(F.col("ref.fields"), F.col("fields"))).otherwise(F.col("fields"))
        .alias("fields"),
    )


def with_payload(resolved: DataFrame, records: DataFrame, payload: str) -> DataFrame:
    """Resolved revisits with the payload column of the response they refer to. One payload may
    be wanted by many revisits: the join is on its record id, which adaptive execution splits."""
    held = records.where("kind = 'response'").select(
        F.col("record_id").alias("ref_id"), F.col(payload).alias("payload")
    ).dropDuplicates(["ref_id"])
    return resolved.drop("payload").where("status = 'resolved'").join(held, "ref_id")


def crawl(pages: DataFrame) -> DataFrame:
    """Records of a crawl that meets every page twice, from (page_id, url, html): a response at
    the time of its id, and at a later time a not-modified answer at another spelling of the
    URL. Some answers carry an old entity tag, some none but a date, some nothing."""
    digest = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    id_ = F.col("page_id")
    date = F.concat(F.lit("day "), (id_ % 97).cast("string"))
    once = pages.select(
        (id_ * 2).alias("record_id"), "url", id_.alias("at"), F.lit("response").alias("kind"),
        F.when(id_ % 11 != 3, tag).alias("etag"), date.alias("last_modified"),
        digest.alias("digest"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("Server"), F.lit("origin"),
            F.lit("Date"), date, F.lit("Cache-Control"), F.lit("max-age=60"),
        ).alias("headers"),
    )
    again = pages.select(
        (id_ * 2 + 1).alias("record_id"),
        F.concat(F.regexp_replace("url", r"\Ahttps?://(?:www\.)?", "HTTP://WWW."), F.lit("#again")).alias("url"),
        (id_ + 1 + id_ % 5000).alias("at"), F.lit("revisit").alias("kind"),
        F.when(id_ % 7 == 0, F.lit(None).cast("string")).when(id_ % 5 == 0, F.lit('"old"'))
        .otherwise(F.concat(F.lit("W/"), tag)).alias("etag"),
        F.when(id_ % 21 != 0, date).alias("last_modified"), F.lit(None).cast("string").alias("digest"),
        F.create_map(
            F.lit("DATE"), F.concat(F.lit("later "), date), F.lit("Server"), F.lit("cache"),
            F.lit("Vary"), F.lit("Accept"),
        ).alias("headers"),
    )
    return once.unionByName(again)


# The same crawl and the same resolution for DuckDB.
ORACLE = r"""
WITH p AS (
  SELECT page_id AS id, url, md5(coalesce(html, '')) AS digest,
    'day ' || (page_id % 97) AS d, '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag
  FROM pages
), spelled AS (
  SELECT *, url AS u1, regexp_replace(url, '^https?://(www\.)?', 'HTTP://WWW.') || '#again' AS u2 FROM p
), bare AS (
  SELECT *, regexp_replace(regexp_replace(trim(u1), '#.*', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b1,
    regexp_replace(regexp_replace(trim(u2), '#.*', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b2 FROM spelled
), parts AS (
  SELECT *, split_part(b1, '?', 1) AS p1, split_part(b2, '?', 1) AS p2,
    CASE WHEN strpos(b1, '?') > 0 THEN substr(b1, strpos(b1, '?') + 1) ELSE '' END AS q1,
    CASE WHEN strpos(b2, '?') > 0 THEN substr(b2, strpos(b2, '?') + 1) ELSE '' END AS q2 FROM bare
), hosts AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(split_part(p1, '/', 1)), '^[^@]*@', ''), ':(80|443)$', ''), '^www\.', '') AS h1,
    regexp_replace(regexp_replace(regexp_replace(lower(split_part(p2, '/', 1)), '^[^@]*@', ''), ':(80|443)$', ''), '^www\.', '') AS h2,
    regexp_replace(CASE WHEN strpos(p1, '/') > 0 THEN substr(p1, strpos(p1, '/')) ELSE '' END, '/+$', '') AS t1,
    regexp_replace(CASE WHEN strpos(p2, '/') > 0 THEN substr(p2, strpos(p2, '/')) ELSE '' END, '/+$', '') AS t2,
    list_sort(list_filter(string_split(q1, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref)='))) AS l1,
    list_sort(list_filter(string_split(q2, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref)='))) AS l2
  FROM parts
), keyed AS (
  SELECT *, h1 || t1 || CASE WHEN len(l1) > 0 THEN '?' || array_to_string(l1, '&') ELSE '' END AS k1,
    h2 || t2 || CASE WHEN len(l2) > 0 THEN '?' || array_to_string(l2, '&') ELSE '' END AS k2 FROM hosts
), resp AS (
  SELECT k1 AS url_key, id AS "at", max(id * 2) AS record_id FROM keyed GROUP BY k1, id
), rev AS (
  SELECT id * 2 + 1 AS record_id, k2 AS url_key, id + 1 + id % 5000 AS "at", d,
    CASE WHEN id % 7 = 0 THEN NULL WHEN id % 5 = 0 THEN '"old"' ELSE tag END AS etag,
    CASE WHEN id % 21 <> 0 THEN d END AS last_modified FROM keyed
), hit AS (
  SELECT rev.*, (SELECT max(resp."at") FROM resp WHERE resp.url_key = rev.url_key AND resp."at" < rev."at") AS rat FROM rev
), ref AS (
  SELECT hit.*, resp.record_id AS rid, CASE WHEN resp.record_id / 2 % 11 <> 3 THEN keyed.tag END AS rtag, keyed.d AS rd
  FROM hit LEFT JOIN resp ON resp.url_key = hit.url_key AND resp."at" = hit.rat
  LEFT JOIN keyed ON keyed.id * 2 = resp.record_id
), judged AS (
  SELECT *, CASE WHEN rid IS NULL THEN 'orphan'
    WHEN etag IS NOT NULL AND rtag IS NOT NULL THEN CASE WHEN etag = rtag THEN 'resolved' ELSE 'mismatch' END
    WHEN last_modified IS NOT NULL THEN CASE WHEN last_modified = rd THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unverified' END AS status FROM ref
)
SELECT record_id, url_key, "at", status, CASE WHEN status = 'resolved' THEN rid END AS ref_id,
  CASE WHEN status = 'resolved' THEN rat END AS ref_at,
  CASE WHEN status = 'resolved'
    THEN 'cache-control=max-age=60;content-type=text/html;date=later ' || d || ';server=origin;vary=Accept'
    ELSE 'date=later ' || d || ';server=cache;vary=Accept' END AS fields
FROM judged
"""
