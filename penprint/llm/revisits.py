"""Not-modified revisits of web archives resolved against the latest earlier full response of the same address."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from penprint.llm.common import written

#: Headers that a 304 response may change in the stored one; lengths, encodings and types stay with the stored body.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|phpsessid|jsessionid|sessionid)(=|$)"
START = r"^[a-zA-Z][a-zA-Z0-9+.-]*://"


def canonical(url: Column, tracking: str = TRACKING) -> Column:
    """Host, path and sorted query of an address: without scheme, user, default port, www, fragment, trailing slashes
    and tracking parameters; the host in lower case. Null for null and for text that is not an absolute address."""
    text = F.trim(url)
    scheme = F.lower(F.regexp_extract(text, r"^([a-zA-Z][a-zA-Z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_replace(F.regexp_extract(text, START + r"([^/?#]*)", 1), r"^[^@]*@", ""))
    host = F.when(scheme == "http", F.regexp_replace(host, r":80$", "")).when(scheme == "https", F.regexp_replace(host, r":443$", "")).otherwise(host)
    host = F.regexp_replace(host, r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(text, START + r"[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(text, r"^[^?#]*\?([^#]*)", 1), "&")
    query = F.array_sort(F.filter(query, lambda p: (p != "") & ~F.lower(p).rlike(tracking)))
    whole = F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(F.lit("")))
    return F.when(text.rlike(START), whole)


def lowered(headers: Column) -> Column:
    """Header names in lower case; of names that then clash the last one counts. Null is the empty map."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda o: o["key"] == e["key"]))
    return F.coalesce(F.map_from_entries(last), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def merged(stored: Column, update: Column, permitted: Sequence[str] = PERMITTED) -> Column:
    """The stored headers with the permitted ones of the update in their place."""
    new = F.map_filter(update, lambda k, _: k.isin(list(permitted)))
    return F.map_concat(F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new)


def latest_before(rows: DataFrame, key: str, order: Sequence[str], full: str, identity: str) -> DataFrame:
    """Add the identity of the latest row with ``full`` before each row of the same key, in the given order.

    Rows are cut into ordered ranges, so that a key with most rows is many ranges. Inside a range the last full row is
    carried along; the ranges' last full rows are carried over them in a table of one row per range.
    """
    at = F.when(F.col(full), F.struct(F.col(key).alias("key"), F.col(identity).alias("id")))
    ranged = rows.repartitionByRange(key, *order).withColumn("_range", F.spark_partition_id())
    ranged = written(ranged.withColumn("_at", at), "ranges")
    inside = Window.partitionBy("_range").orderBy(key, *order)
    place = F.struct(F.col(key).alias("k"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    ends = ranged.where("_at is not null").groupBy("_range").agg(F.max_by("_at", place).alias("_end"))
    all_ranges = ranged.select("_range").distinct().join(ends, "_range", "left")
    over = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    carried = all_ranges.select("_range", F.last("_end", ignorenulls=True).over(over).alias("_carried"))
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    found = F.coalesce(F.last("_at", ignorenulls=True).over(before), F.col("_carried"))
    joined = ranged.join(F.broadcast(carried), "_range").withColumn("_found", found)
    return joined.withColumn("source_id", F.when(F.col("_found.key") == F.col(key), F.col("_found.id"))).drop("_range", "_at", "_carried", "_found")


def resolved(records: DataFrame, permitted: Sequence[str] = PERMITTED, tracking: str = TRACKING) -> DataFrame:
    """Every capture, revisits filled in from the latest earlier full response of their canonical address.

    ``records``: record_id, url, ts, kind (response or revisit), status, etag, last_modified, digest, headers (map),
    body. A full response has status 200 and a body. Earlier means a smaller ts; of responses with equal ts the one
    with the largest id counts. A revisit fits if the entity tags are equal without their weakness mark; where one has
    none, if the dates of last change are equal; where one has none, if the digests are. Adds url_key, outcome
    (response, resolved, no_earlier, mismatch) and source_id; a resolved revisit takes body, digest and status of its
    source and the merged headers, others stay as they are. Null addresses and times have no earlier response; repeated
    ids are separate rows that share their outcome's source if they share address and time; extra columns pass.
    """
    rows = records.withColumn("url_key", canonical(F.col("url"), tracking)).withColumn("headers", lowered(F.col("headers")))
    full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200) & F.col("body").isNotNull(), F.lit(False))
    keys = rows.where("url_key is not null and ts is not null").select("url_key", "ts", full.alias("full"), "record_id", "kind").distinct()
    # a response is not earlier than a revisit of the same time: the revisit comes first
    found = latest_before(keys.withColumn("place", F.struct("ts", "record_id")), "url_key", ["ts", "full", "record_id"], "full", "place")
    found = found.where("kind = 'revisit'").select("record_id", "url_key", "ts", F.col("source_id.ts").alias("_ts"), F.col("source_id.record_id").alias("source_id"))
    # ids alone may repeat: a source is named by address, time and id
    one = Window.partitionBy("url_key", "_ts", "source_id").orderBy(F.desc("_hash"), F.desc("_other"))
    stored = rows.where(full).select(
        "url_key", F.col("ts").alias("_ts"), F.col("record_id").alias("source_id"), F.xxhash64("body").alias("_hash"), F.xxhash64("etag", "last_modified", "digest").alias("_other"),
        F.struct("url_key", "status", "etag", "last_modified", "digest", "headers", "body").alias("_source"),
    )
    responses = stored.withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n", "_hash", "_other")
    revisits = rows.where("kind = 'revisit'").join(found, ["record_id", "url_key", "ts"], "left")
    joined = revisits.join(responses, ["url_key", "_ts", "source_id"], "left").drop("_ts")

    def equal(name: str, rest: Column) -> Column:
        one, other = F.col(name), F.col(f"_source.{name}")
        if name == "etag":
            one, other = (F.regexp_replace(c, r"^W/", "") for c in (one, other))
        return F.when(one.isNotNull() & other.isNotNull(), one == other).otherwise(rest)

    fits = equal("etag", equal("last_modified", equal("digest", F.lit(False))))
    outcome = F.when(F.col("_source").isNull(), "no_earlier").when(fits, "resolved").otherwise("mismatch")
    joined = joined.withColumn("outcome", outcome)
    hit = F.col("outcome") == "resolved"
    filled = {c: F.when(hit, F.col(f"_source.{c}")).otherwise(F.col(c)) for c in ("body", "digest", "status")}
    filled["headers"] = F.when(hit, merged(F.col("_source.headers"), F.col("headers"), permitted)).otherwise(F.col("headers"))
    filled["source_id"] = F.when(hit, F.col("source_id"))
    joined = joined.withColumns(filled).drop("_source")
    plain = rows.where("kind is null or kind <> 'revisit'").withColumn("outcome", F.lit("response"))
    plain = plain.withColumn("source_id", F.lit(None).cast(joined.schema["source_id"].dataType))
    return plain.unionByName(joined.select(plain.columns))


def captures(pages: DataFrame) -> DataFrame:
    """Archive records derived from the pages: of each page a response, a later change of every third, and two revisits.

    Times, entity tags and dates follow from hashes of the page's id, so some revisits precede their response, some
    carry another tag, and some have no tag but a date or a digest.
    """

    def number(label: str, modulus: int) -> Column:
        digits = F.substring(F.md5(F.concat(F.col("page_id").cast("string"), F.lit(":" + label)).cast("binary")), 1, 7)
        return F.conv(digits, 16, 10).cast("bigint") % modulus

    digest = F.md5(F.col("html").cast("binary"))
    changed = F.concat(F.col("html"), F.lit("<!-- changed -->"))
    page, day = F.col("page_id"), 86400

    def record(k: int, kind: str, ts: Column, etag: Column, modified: Column, sha: Column, body: Column) -> Column:
        length = F.coalesce(F.char_length(body).cast("string"), F.lit("0"))
        headers = F.create_map(
            F.lit("Content-Type"), F.lit("text/html" if kind == "response" else "text/plain"), F.lit("Content-Length"), length,
            F.lit("Date"), ts.cast("string"), F.lit("Cache-Control"), F.concat(F.lit("max-age="), number(f"age{k}", 1000).cast("string")),
        )
        return F.struct(
            (page * 4 + k).alias("record_id"), F.col("url").alias("url"), ts.alias("ts"), F.lit(kind).alias("kind"),
            F.lit(200 if kind == "response" else 304).alias("status"), etag.alias("etag"), modified.alias("last_modified"),
            sha.alias("digest"), headers.alias("headers"), body.alias("body"),
        )

    none = F.lit(None).cast("string")
    first = number("first", 100 * day)
    modified = (number("modified", 1000)).cast("string")
    tag = F.when(number("tagged", 4) > 0, digest)
    other = F.when(number("stale", 5) == 0, F.lit("stale")).otherwise(F.concat(F.lit("W/"), digest))
    parts = [
        record(0, "response", first, tag, modified, digest, F.col("html")),
        record(1, "revisit", number("again", 200 * day), F.when(number("tagless", 3) > 0, other), F.when(number("dated", 2) > 0, modified), digest, none),
        record(2, "revisit", first + number("later", 30 * day), F.when(number("tagless2", 3) > 0, F.concat(F.lit("W/"), digest)), none, digest, none),
    ]
    change = record(3, "response", first + number("change", 60 * day), F.md5(changed.cast("binary")), (number("modified", 1000) + 1).cast("string"), F.md5(changed.cast("binary")), changed)
    records = F.when(number("changes", 3) == 0, F.array(*parts, change)).otherwise(F.array(*parts))
    return pages.select(F.explode(records).alias("r")).select("r.*")


def op3_revisits(spark: SparkSession, folder: str) -> DataFrame:
    records = captures(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html"))
    headers = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return resolved(records).select(
        "record_id", "url_key", "outcome", "source_id", "status", F.md5(F.col("body").cast("binary")).alias("body_md5"),
        F.char_length("body").cast("bigint").alias("n_chars"), F.array_join(headers, ";").alias("headers"),
    )


SQL = r"""
WITH p AS (
  SELECT page_id, url, html, md5(html) AS digest, html || '<!-- changed -->' AS changed,
         trim(url) AS u, lower(regexp_extract(trim(url), '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1)) AS scheme
  FROM pages
), h AS (
  SELECT *, lower(regexp_replace(regexp_extract(u, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), '^[^@]*@', '')) AS authority,
         regexp_replace(regexp_extract(u, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(u, '^[^?#]*\?([^#]*)', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|ref|fbclid|gclid|phpsessid|jsessionid|sessionid)(=|$)'))) AS q
  FROM p
), k AS (
  SELECT *, CASE WHEN regexp_matches(u, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN
      regexp_replace(CASE scheme WHEN 'http' THEN regexp_replace(authority, ':80$', '') WHEN 'https' THEN regexp_replace(authority, ':443$', '')
                     ELSE authority END, '^www[0-9]*\.', '') || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS url_key
  FROM h
), n AS (
  SELECT *, ('0x' || substr(md5(page_id || ':first'), 1, 7))::BIGINT % 8640000 AS first_ts,
         ('0x' || substr(md5(page_id || ':modified'), 1, 7))::BIGINT % 1000 AS modified,
         ('0x' || substr(md5(page_id || ':tagged'), 1, 7))::BIGINT % 4 AS tagged,
         ('0x' || substr(md5(page_id || ':stale'), 1, 7))::BIGINT % 5 AS stale,
         ('0x' || substr(md5(page_id || ':again'), 1, 7))::BIGINT % 17280000 AS again,
         ('0x' || substr(md5(page_id || ':tagless'), 1, 7))::BIGINT % 3 AS tagless,
         ('0x' || substr(md5(page_id || ':dated'), 1, 7))::BIGINT % 2 AS dated,
         ('0x' || substr(md5(page_id || ':later'), 1, 7))::BIGINT % 2592000 AS later,
         ('0x' || substr(md5(page_id || ':tagless2'), 1, 7))::BIGINT % 3 AS tagless2,
         ('0x' || substr(md5(page_id || ':change'), 1, 7))::BIGINT % 5184000 AS change,
         ('0x' || substr(md5(page_id || ':changes'), 1, 7))::BIGINT % 3 AS changes,
         ('0x' || substr(md5(page_id || ':age0'), 1, 7))::BIGINT % 1000 AS age0, ('0x' || substr(md5(page_id || ':age1'), 1, 7))::BIGINT % 1000 AS age1,
         ('0x' || substr(md5(page_id || ':age2'), 1, 7))::BIGINT % 1000 AS age2, ('0x' || substr(md5(page_id || ':age3'), 1, 7))::BIGINT % 1000 AS age3
  FROM k
), r AS (
  SELECT page_id * 4 AS record_id, url_key, first_ts AS ts, 'response' AS kind, CASE WHEN tagged > 0 THEN digest END AS etag,
         modified::VARCHAR AS last_modified, digest, age0 AS age, html AS body FROM n
  UNION ALL
  SELECT page_id * 4 + 1, url_key, again, 'revisit', CASE WHEN tagless > 0 THEN CASE WHEN stale = 0 THEN 'stale' ELSE digest END END,
         CASE WHEN dated > 0 THEN modified::VARCHAR END, digest, age1, NULL FROM n
  UNION ALL
  SELECT page_id * 4 + 2, url_key, first_ts + later, 'revisit', CASE WHEN tagless2 > 0 THEN digest END, NULL, digest, age2, NULL FROM n
  UNION ALL
  SELECT page_id * 4 + 3, url_key, first_ts + change, 'response', md5(changed), (modified + 1)::VARCHAR, md5(changed), age3, changed FROM n WHERE changes = 0
), s AS (
  SELECT v.record_id, arg_max(f.record_id, (f.ts, f.record_id)) AS source_id
  FROM r v JOIN r f ON v.kind = 'revisit' AND f.kind = 'response' AND f.body IS NOT NULL AND f.url_key = v.url_key AND f.ts < v.ts
  GROUP BY v.record_id
), j AS (
  SELECT v.*, f.record_id AS found, f.body AS stored, f.etag AS etag2, f.last_modified AS modified2, f.digest AS digest2
  FROM r v LEFT JOIN s ON s.record_id = v.record_id LEFT JOIN r f ON f.record_id = s.source_id
), o AS (
  SELECT *, CASE WHEN kind = 'response' THEN 'response' WHEN found IS NULL THEN 'no_earlier'
    WHEN CASE WHEN etag IS NOT NULL AND etag2 IS NOT NULL THEN etag = etag2
              WHEN last_modified IS NOT NULL AND modified2 IS NOT NULL THEN last_modified = modified2
              WHEN digest IS NOT NULL AND digest2 IS NOT NULL THEN digest = digest2 ELSE false END THEN 'resolved'
    ELSE 'mismatch' END AS outcome FROM j
)
SELECT record_id, url_key, outcome, CASE WHEN outcome = 'resolved' THEN found END AS source_id,
       (CASE WHEN outcome IN ('response', 'resolved') THEN 200 ELSE 304 END)::INTEGER AS status,
       md5(CASE outcome WHEN 'response' THEN body WHEN 'resolved' THEN stored END) AS body_md5,
       length(CASE outcome WHEN 'response' THEN body WHEN 'resolved' THEN stored END)::BIGINT AS n_chars,
       'cache-control=max-age=' || age || ';content-length=' || coalesce(length(CASE outcome WHEN 'response' THEN body WHEN 'resolved' THEN stored END), 0)
         || ';content-type=' || CASE WHEN outcome IN ('response', 'resolved') THEN 'text/html' ELSE 'text/plain' END || ';date=' || ts AS headers
FROM o
"""
