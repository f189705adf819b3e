"""WARC revisits: a not-modified capture takes its body from the latest earlier full response.

``resolve_revisits`` is an as-of join of ``revisit`` records with ``response`` records of the same
canonical URL on (date, record id). The revisit's validators are checked against that response (ETag
by weak comparison; Last-Modified only where the revisit has no ETag), and header fields that a 304
may update replace those of the response.

The join sorts all records by (URL, date, id) over range partitions, whatever the URL: one URL with
most of the captures spreads over many partitions. Inside a partition a window finds the last
response; the last response of each (URL, partition) is carried on to the URL's later partitions.

Defined results: a null or unparseable URL has the canonical URL ``""`` and is never joined (``no_url``);
a null header block has no fields; of records equal in URL and date the smaller id is earlier; repeated
rows are each resolved; a revisit without validators is ``no_validator``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.storage import stage

#: Fields of a 304 response that update the stored response (fixed values, RFC 9110 section 15.4.5 and RFC 9111 section 3.2).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't select content (fixed values).
TRACKING = "utm_[^=&]*|gclid|fbclid|ref"


def canonical_url(url: Column) -> Column:
    """Host (lower case, without www., default port) + path (without a closing slash) + query (sorted, without tracking)."""
    trimmed = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "#.*$", "")
    host = F.lower(F.regexp_extract(trimmed, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]+)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(trimmed, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]+([^?]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(trimmed, "\\?(.*)$", 1), "&")
    query = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)"))), "&")
    return F.when(host == "", F.lit("")).otherwise(F.concat(host, path, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))))


def header_fields(block: Column) -> Column:
    """The fields of a header block, names in lower case, without the status line."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), "\r?\n"), lambda x: x.rlike("^[^\\s:]+:"))
    return F.transform(lines, lambda x: F.struct(F.lower(F.regexp_extract(x, "^([^:]+):", 1)).alias("name"), F.trim(F.regexp_extract(x, "^[^:]+:(.*)$", 1)).alias("value")))


def field(fields: Column, name: str) -> Column:
    return F.get(F.filter(fields, lambda f: f["name"] == name), 0)["value"]


def merged_fields(stored: Column, update: Column) -> Column:
    new = F.filter(update, lambda f: f["name"].isin(*PERMITTED))
    old = F.filter(stored, lambda f: ~F.exists(new, lambda n: n["name"] == f["name"]))
    return F.array_sort(F.concat(old, new))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """record_id, canonical_url, warc_type, outcome, response_id, payload_digest, headers for every record.

    ``records``: record_id long, warc_type, target_uri, warc_date timestamp, http_headers, payload_digest.
    """
    rows = records.select("record_id", "warc_type", "warc_date", canonical_url(F.col("target_uri")).alias("url"), header_fields(F.col("http_headers")).alias("fields"), "payload_digest")
    rows = rows.repartitionByRange("url", "warc_date", "record_id").withColumn("part", F.spark_partition_id())
    rows = stage(rows, "captures")
    full = F.when(F.col("warc_type") == "response", F.struct("record_id", "fields", "payload_digest"))
    order = ["warc_date", "record_id"]
    inside = Window.partitionBy("url", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # At most one row for each URL and range partition.
    ends = rows.where("warc_type = 'response'").groupBy("url", "part").agg(F.max_by(F.struct("record_id", "fields", "payload_digest"), F.struct(*order)).alias("end"))
    spans = rows.groupBy("url", "part").agg(F.count("*").alias("n")).join(ends, ["url", "part"], "left")
    carried = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = spans.select(F.col("url").alias("u"), F.col("part").alias("p"), F.last("end", ignorenulls=True).over(carried).alias("carried"))
    carry = carry.where("carried is not null")
    seen = rows.withColumn("near", F.last(full, ignorenulls=True).over(inside)).join(carry, (F.col("url") == F.col("u")) & (F.col("part") == F.col("p")), "left")
    source = F.when(F.col("url") != "", F.coalesce("near", "carried"))
    seen = seen.withColumn("source", source)
    etag = lambda f: F.regexp_replace(field(f, "etag"), "^W/", "")
    mine, stored = F.col("fields"), F.col("source.fields")
    same = F.when(field(mine, "etag").isNotNull(), etag(mine) == etag(stored)).otherwise(field(mine, "last-modified") == field(stored, "last-modified"))
    outcome = (
        F.when(F.coalesce(F.col("warc_type") != "revisit", F.lit(True)), "full")
        .when(F.col("url") == "", "no_url")
        .when(F.col("source").isNull(), "no_earlier_response")
        .when(field(mine, "etag").isNull() & field(mine, "last-modified").isNull(), "no_validator")
        .when(F.coalesce(same, F.lit(False)), "resolved")
        .otherwise("validator_mismatch")
    )
    out = seen.withColumn("outcome", outcome)
    done = F.col("outcome") == "resolved"
    text = lambda f: F.array_join(F.transform(f, lambda x: F.concat(x["name"], F.lit(": "), x["value"])), "\n")
    return out.select(
        "record_id", F.col("url").alias("canonical_url"), "warc_type", "outcome",
        F.when(done, F.col("source.record_id")).alias("response_id"),
        F.when(done, F.col("source.payload_digest")).when(F.col("outcome") == "full", F.col("payload_digest")).alias("payload_digest"),
        text(F.when(done, merged_fields(stored, mine)).otherwise(F.array_sort(mine))).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """WARC records made of ``pages``: a full response of every page, one a minute, and a day later a 304 of every third."""
    seen = F.when(F.col("page_id") % 3 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    pages = pages.withColumn("again", F.explode(seen))
    k, revisit = F.col("page_id"), F.col("again") == 1
    date = F.timestamp_seconds(F.lit(1_704_067_200) + 60 * k + 86_400 * F.col("again"))
    # Every fourth page has changed by its revisit.
    version = (k % 2 + F.when(k % 4 == 0, F.col("again")).otherwise(0)).cast("string")
    stamp = F.concat(F.date_format(date, "yyyy-MM-dd HH:mm:ss"), F.lit(" GMT"))
    lines = F.filter(
        F.array(
            F.when(revisit, F.lit("HTTP/1.1 304 Not Modified")).otherwise(F.lit("HTTP/1.1 200 OK")),
            F.when(~revisit, F.lit("Content-Type: text/html")),
            F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.octet_length(F.coalesce("html", F.lit("")))).cast("string")),
            F.concat(F.lit("Date: "), stamp),
            F.when(k % 5 != 0, F.concat(F.lit('ETag: W/"v'), version, F.lit('"'))),
            F.when(k % 7 != 0, F.concat(F.lit("Last-Modified: "), version)),
            F.concat(F.lit("Cache-Control: max-age="), (k % 11).cast("string")),
        ),
        lambda x: x.isNotNull(),
    )
    return pages.select(
        (2 * k + F.col("again")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("warc_type"), F.col("url").alias("target_uri"), date.alias("warc_date"),
        F.concat(F.array_join(lines, "\r\n"), F.lit("\r\n\r\n")).alias("http_headers"), F.when(~revisit, F.sha2(F.coalesce("html", F.lit("")), 256)).alias("payload_digest"),
    )


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_revisits(captures(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")))


ORACLE_SQL = r"""
WITH c AS (
  SELECT 2 * page_id + again AS record_id, page_id, html, again = 1 AS revisit, page_id + 1440 * again AS minute,
    CAST(page_id % 2 + CASE WHEN page_id % 4 = 0 THEN again ELSE 0 END AS VARCHAR) AS version,
    regexp_replace(trim(coalesce(url, '')), '#.*$', '') AS u,
    strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(page_id + 1440 * again AS BIGINT)), '%Y-%m-%d %H:%M:%S') || ' GMT' AS stamp
  FROM (SELECT *, unnest(CASE WHEN page_id % 3 = 1 THEN [0, 1] ELSE [0] END) AS again FROM pages)
), p AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]+)', 1)), '^www\.', ''), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]+([^?]*)', 1), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=&]*|gclid|fbclid|ref)(=|$)'))), '&') AS query
  FROM c
), r AS (
  SELECT record_id, minute, revisit, CASE WHEN host = '' THEN '' ELSE host || path || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS canonical_url,
    CASE WHEN NOT revisit THEN sha256(coalesce(html, '')) END AS digest,
    CASE WHEN page_id % 5 <> 0 THEN 'W/"v' || version || '"' END AS etag,
    CASE WHEN page_id % 7 <> 0 THEN version END AS modified,
    stamp, 'max-age=' || CAST(page_id % 11 AS VARCHAR) AS cache, CASE WHEN revisit THEN 0 ELSE octet_length(encode(coalesce(html, ''))) END AS size
  FROM p
), a AS (
  SELECT *, last_value(CASE WHEN NOT revisit THEN record_id END IGNORE NULLS) OVER (PARTITION BY canonical_url ORDER BY minute, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS source FROM r
), j AS (
  SELECT a.*, s.etag AS s_etag, s.modified AS s_modified, s.digest AS s_digest, s.size AS s_size,
    CASE WHEN NOT a.revisit THEN 'full' WHEN a.canonical_url = '' THEN 'no_url' WHEN s.record_id IS NULL THEN 'no_earlier_response'
      WHEN a.etag IS NULL AND a.modified IS NULL THEN 'no_validator'
      WHEN coalesce(CASE WHEN a.etag IS NOT NULL THEN a.etag = s.etag ELSE a.modified = s.modified END, false) THEN 'resolved' ELSE 'validator_mismatch' END AS outcome
  FROM a LEFT JOIN r s ON s.record_id = a.source
)
SELECT record_id, canonical_url, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS warc_type, outcome,
  CASE WHEN outcome = 'resolved' THEN source END AS response_id,
  CASE WHEN outcome = 'resolved' THEN s_digest WHEN outcome = 'full' THEN digest END AS payload_digest,
  concat_ws(chr(10), 'cache-control: ' || cache, 'content-length: ' || CAST(CASE WHEN outcome = 'resolved' THEN s_size ELSE size END AS VARCHAR),
    CASE WHEN outcome = 'resolved' OR NOT revisit THEN 'content-type: text/html' END, 'date: ' || stamp,
    'etag: ' || CASE WHEN outcome = 'resolved' THEN coalesce(etag, s_etag) ELSE etag END,
    'last-modified: ' || CASE WHEN outcome = 'resolved' THEN coalesce(modified, s_modified) ELSE modified END) AS headers
FROM j
"""
