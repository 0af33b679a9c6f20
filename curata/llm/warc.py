"""Not-modified revisit resolution for web archives, as a split as-of join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Headers that a 304 answer may replace in the stored response.
MERGED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Seconds of archive time in one part of a URL's history.
PART_SECONDS = 86_400


def canonical_url(url: Column) -> Column:
    """Host in lower case without default port, path without closing slashes, query without tracking parameters and sorted.

    The scheme and the fragment go; null or a text without ``://`` stays as it is.
    """
    rest = F.regexp_replace(F.regexp_replace(url, r"^[^:/?#]*://", ""), r"#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^utm_")))
    made = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(url.isNull() | ~url.contains("://"), url).otherwise(made)


def resolve_revisits(records: DataFrame, part_seconds: int = PART_SECONDS) -> DataFrame:
    """One row per revisit record with the full response that it stands for.

    ``records``: record_id long, url string, ts long (seconds), kind string
    (``response`` or ``revisit``), status int, etag, last_modified string,
    headers map<string,string> with lower-case names, payload_ref of any type.
    The response is the latest one of the same canonical URL strictly before
    the revisit (of equal times the larger record_id).  Validators: if both
    have an etag it must be equal (weak marks aside), else if both have
    last_modified that must be, else the revisit can't be confirmed.
    ``outcome``: ``resolved``, ``mismatch``, ``unconfirmed`` or ``orphan``
    (no earlier response, null URL or null time).  Headers of a resolved
    revisit are the response's, with those of ``MERGED`` that the revisit
    brings; other outcomes keep the revisit's own.  Other columns are ignored.

    A URL's history is cut into parts of ``part_seconds``.  The last response
    of each part is an aggregate; the latest one before a part comes from a
    window over the parts, within a part from a window over its rows.  So no
    task holds all captures of a hot URL, and payloads never move.
    """
    base = records.select(
        "record_id",
        "ts",
        "kind",
        canonical_url(F.col("url")).alias("curl"),
        F.floor(F.col("ts") / part_seconds).alias("part"),
        F.struct("ts", "record_id", "status", "etag", "last_modified", "headers", "payload_ref").alias("rec"),
    )
    lost = F.col("curl").isNull() | F.col("ts").isNull()
    full = F.when(F.col("kind") == "response", F.col("rec"))
    # maps can't be compared, so the order is carried by (ts, record_id)
    last = base.where(~lost & (F.col("kind") == "response")).groupBy("curl", "part").agg(F.max_by("rec", F.struct("ts", "record_id")).alias("last"))
    parts = base.where(~lost).select("curl", "part").distinct().join(last, ["curl", "part"], "left")
    before = Window.partitionBy("curl").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("curl", "part", F.last("last", ignorenulls=True).over(before).alias("carried"))
    inside = Window.partitionBy("curl", "part").orderBy("ts", F.when(F.col("kind") == "revisit", 0).otherwise(1), "record_id")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    near = base.where(~lost).withColumn("near", F.last(full, ignorenulls=True).over(inside)).where("kind = 'revisit'")
    found = near.join(parts, ["curl", "part"]).select("record_id", "curl", "rec", F.coalesce("near", "carried").alias("src"))
    none = base.where(lost & (F.col("kind") == "revisit"))
    found = found.unionByName(none.select("record_id", "curl", "rec", F.lit(None).cast(found.schema["src"].dataType).alias("src")))

    def tag(c: str) -> Column:
        return F.regexp_replace(F.col(c), "^W/", "")

    etags = F.col("rec.etag").isNotNull() & F.col("src.etag").isNotNull()
    times = F.col("rec.last_modified").isNotNull() & F.col("src.last_modified").isNotNull()
    outcome = (
        F.when(F.col("src").isNull(), "orphan")
        .when(etags, F.when(tag("rec.etag") == tag("src.etag"), "resolved").otherwise("mismatch"))
        .when(times, F.when(F.col("rec.last_modified") == F.col("src.last_modified"), "resolved").otherwise("mismatch"))
        .otherwise("unconfirmed")
    )
    new = F.map_filter(F.coalesce("rec.headers", F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*MERGED))
    old = F.map_filter(F.coalesce("src.headers", F.create_map().cast("map<string,string>")), lambda k, v: ~F.map_contains_key(new, k))
    done = found.withColumn("outcome", outcome)
    ok = F.col("outcome") == "resolved"
    return done.select(
        "record_id",
        F.col("curl").alias("canonical_url"),
        "outcome",
        F.col("src.record_id").alias("response_id"),
        F.when(ok, F.col("src.status")).otherwise(F.col("rec.status")).alias("status"),
        F.when(ok, F.map_concat(old, new)).otherwise(F.col("rec.headers")).alias("headers"),
        F.when(ok, F.col("src.payload_ref")).alias("payload_ref"),
    )


def records_of_pages(pages: DataFrame) -> DataFrame:
    """The archive that the query resolves: for every page one response and two revisits, all derived from the page.

    A page is captured at ``page_id * 60`` seconds.  One revisit follows after
    an hour under another spelling of the URL, with the page's etag (every
    seventh page: a wrong one).  The other has no etag, only a date, and comes
    thirty seconds before the capture on every fifth page, else a day after.
    Payload references are the page's SHA-256 and length.
    """
    p = pages.select(
        F.col("page_id").alias("id"),
        "url",
        F.md5(F.coalesce("html", F.lit("")).cast("binary")).alias("tag"),
        F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("sha"),
        F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("n"),
    )
    t = F.col("id") * 60
    none = F.lit(None).cast("string")

    def record(k: int, ts: Column, url: Column, kind: str, status: int, etag: Column, modified: Column, headers: list[Column], ref: Column) -> Column:
        return F.struct(
            (F.col("id") * 3 + k).alias("record_id"),
            url.alias("url"),
            ts.cast("long").alias("ts"),
            F.lit(kind).alias("kind"),
            F.lit(status).alias("status"),
            etag.alias("etag"),
            modified.alias("last_modified"),
            F.create_map(*headers).alias("headers"),
            ref.alias("payload_ref"),
        )

    ref = F.struct(F.col("sha").alias("sha"), F.col("n").alias("n"))
    no_ref = F.lit(None).cast("struct<sha:string,n:bigint>")
    day = F.concat(F.lit("day "), (F.col("id") % 365).cast("string"))
    html = [F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.col("n").cast("string"), F.lit("date"), t.cast("string")]
    wrong = F.when(F.col("id") % 7 == 0, F.lit("stale")).otherwise(F.col("tag"))
    again = F.concat(F.regexp_replace(F.regexp_replace("url", "^http:", "https:"), "#.*$", ""), F.lit("#again"))
    dated = [F.lit("date"), (t + 3600).cast("string"), F.lit("content-length"), F.lit("0")]
    late = F.when(F.col("id") % 5 == 0, t - 30).otherwise(t + 86_400)
    three = F.array(
        record(0, t, F.col("url"), "response", 200, F.col("tag"), day, html, ref),
        record(1, t + 3600, again, "revisit", 304, F.concat(F.lit("W/"), wrong), none, dated, no_ref),
        record(2, late, F.col("url"), "revisit", 304, none, day, [F.lit("expires"), F.lit("never")], no_ref),
    )
    return p.select(F.inline(three))


def revisit_digest(pages: DataFrame) -> DataFrame:
    """``record_id, canonical_url, outcome, response_id, status, header_text, payload_sha, payload_bytes`` per revisit."""
    out = resolve_revisits(records_of_pages(pages))
    entries = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.select(
        "record_id",
        "canonical_url",
        "outcome",
        "response_id",
        "status",
        F.array_join(F.array_sort(entries), ";").alias("header_text"),
        F.col("payload_ref.sha").alias("payload_sha"),
        F.col("payload_ref.n").alias("payload_bytes"),
    )


WARC_SQL = r"""
WITH p AS (SELECT page_id AS id, url, md5(coalesce(html, '')) AS tag, sha256(coalesce(html, '')) AS sha,
    octet_length(encode(coalesce(html, '')))::BIGINT AS n, page_id * 60 AS t FROM pages),
r AS (
    SELECT id * 3 AS record_id, url, t AS ts, 'response' AS kind, 200 AS status, tag AS etag,
        'day ' || (id % 365) AS lm, id, sha, n, t FROM p
    UNION ALL
    SELECT id * 3 + 1, regexp_replace(regexp_replace(url, '^http:', 'https:'), '#.*$', '') || '#again', t + 3600, 'revisit', 304,
        CASE WHEN id % 7 = 0 THEN 'stale' ELSE tag END, NULL, id, NULL, NULL, t FROM p
    UNION ALL
    SELECT id * 3 + 2, url, CASE WHEN id % 5 = 0 THEN t - 30 ELSE t + 86400 END, 'revisit', 304,
        NULL, 'day ' || (id % 365), id, NULL, NULL, t FROM p),
s AS (SELECT *, regexp_replace(regexp_replace(url, '^[^:/?#]*://', ''), '#.*$', '') AS rest FROM r),
k AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'),
    lambda x: x <> '' AND NOT starts_with(x, 'utm_'))) AS q FROM s),
c AS (SELECT *, CASE WHEN url IS NULL OR NOT contains(url, '://') THEN url ELSE
    regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), ':(80|443)$', '')
    || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS curl FROM k),
m AS (SELECT v.record_id, v.curl, v.etag, v.lm, v.status, v.t, v.id, f.record_id AS response_id, f.etag AS f_etag, f.lm AS f_lm,
    f.status AS f_status, f.sha, f.n, f.t AS f_t, (v.record_id % 3 = 1) AS dated,
    row_number() OVER (PARTITION BY v.record_id ORDER BY f.ts DESC, f.record_id DESC) AS nth
    FROM c v LEFT JOIN c f ON f.kind = 'response' AND f.curl = v.curl AND f.ts < v.ts WHERE v.kind = 'revisit'),
o AS (SELECT *, CASE WHEN response_id IS NULL THEN 'orphan'
    WHEN etag IS NOT NULL AND f_etag IS NOT NULL THEN CASE WHEN etag = f_etag THEN 'resolved' ELSE 'mismatch' END
    WHEN lm IS NOT NULL AND f_lm IS NOT NULL THEN CASE WHEN lm = f_lm THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unconfirmed' END AS outcome FROM m WHERE nth = 1)
SELECT record_id, curl AS canonical_url, outcome, response_id, CASE WHEN outcome = 'resolved' THEN f_status ELSE status END AS status,
    CASE WHEN outcome = 'resolved' AND dated THEN 'content-length=' || n || ';content-type=text/html;date=' || (t + 3600)
        WHEN outcome = 'resolved' THEN 'content-length=' || n || ';content-type=text/html;date=' || f_t || ';expires=never'
        WHEN dated THEN 'content-length=0;date=' || (t + 3600) ELSE 'expires=never' END AS header_text,
    CASE WHEN outcome = 'resolved' THEN sha END AS payload_sha, CASE WHEN outcome = 'resolved' THEN n END AS payload_bytes
FROM o
"""
