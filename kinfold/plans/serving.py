"""q34 to q46: enrichment, search, detail, reports, export and replay."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.functions.normalize import fixed
from kinfold.operators import enrich
from kinfold.operators.fold import history
from kinfold.operators.postings import like, write_postings
from kinfold.operators.search import latest_reports, search
from kinfold.plans.catalogue import query, table
from kinfold.plans.merging import _ARRIVAL, _FOLD_RESULT, _FOLD_SQL, current, fold, observations
from kinfold.plans.people import valid_times, values_at
from kinfold.plans.quarantine import Check, Reference, Unique, write_checked
from kinfold.storage import shared_dir, stage, written
from kinfold.streaming.archive import Archive
from kinfold.streaming.keyed import fold_stream, with_rocksdb
from kinfold.streaming.replay import ingest_stream


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_acctbal < 5000").select("c_custkey", F.round(F.col("c_acctbal") / 10000, 3).alias("score"))


_SCORED_SQL = "e AS (SELECT c_custkey, round(c_acctbal / 10000, 3) AS score FROM customer WHERE c_acctbal < 5000)"
_BUDGET = 200


@query(
    "q34_budget_rank",
    f"WITH {_SCORED_SQL}, u AS (SELECT * FROM e WHERE c_custkey % 9 <> 0), r AS (SELECT *, row_number() OVER (ORDER BY score DESC, c_custkey) AS position FROM u) SELECT c_custkey, score, position, position <= {_BUDGET - 50} AS selected FROM r",
)
def budget_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    eligible = _scored(spark, sf_dir)
    uncached, _ = enrich.split_cache(eligible, eligible.where("c_custkey % 9 = 0"), "c_custkey")
    return enrich.select_within(uncached, 50, "c_custkey", "score", _BUDGET)


@query("q35_no_key_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def no_key_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(keyed, "c_custkey", "left_anti")


@query(
    "q36_cache_split",
    f"WITH {_SCORED_SQL}, c AS (SELECT DISTINCT doc_id AS c_custkey, min(quality) AS found FROM labels GROUP BY 1) SELECT count(*) FILTER (c.c_custkey IS NULL) AS uncached, count(c.c_custkey) AS cached, count(*) FILTER (found = 0) AS negative_hits, CAST(count(c.c_custkey) * 9 AS BIGINT) AS saved_paise FROM e LEFT JOIN c USING (c_custkey)",
)
def cache_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("c_custkey")).agg(F.min("quality").alias("found"))
    uncached, cached = enrich.split_cache(_scored(spark, sf_dir), cache, "c_custkey")
    both = uncached.select(F.lit(False).alias("hit"), F.lit(None).cast("int").alias("found")).union(cached.join(cache, "c_custkey").select(F.lit(True), "found"))
    return both.agg(F.count_if(~F.col("hit")).alias("uncached"), F.count_if("hit").alias("cached"), F.count_if(F.col("found") == 0).alias("negative_hits"), (F.count_if("hit") * 9).alias("saved_paise"))


@query(
    "q37_lookup_bill",
    f"""
WITH {_SCORED_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, c_custkey) AS position FROM e), s AS (SELECT * FROM r WHERE position <= {_BUDGET}),
p AS (SELECT s_suppkey * 3 AS c_custkey, CASE WHEN s_nationkey % 3 = 0 THEN 'not_found' ELSE 'found' END AS status FROM supplier)
SELECT status, count(*) AS calls, CAST(sum(9) AS BIGINT) AS spend_paise, min(c_custkey) AS first_key FROM s JOIN p USING (c_custkey) GROUP BY status
""",
)
def lookup_bill(spark: SparkSession, sf_dir: str) -> DataFrame:
    provider = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3).alias("c_custkey"), F.when(F.col("s_nationkey") % 3 == 0, "not_found").otherwise("found").alias("status"))
    chosen = enrich.select_within(_scored(spark, sf_dir), 0, "c_custkey", "score", _BUDGET).where("selected")
    billed = enrich.bill(chosen, provider, "c_custkey", F.lit("2026-01-01").cast("timestamp"))
    return billed.groupBy("status").agg(F.count("*").alias("calls"), (F.sum("cost") * 100).cast("long").alias("spend_paise"), F.min("c_custkey").alias("first_key"))


@query("q38_ttl", "SELECT event_id, ts + INTERVAL 30 DAY AS ttl_expires_at, ts + INTERVAL 30 DAY > TIMESTAMP '2024-02-05' AS valid FROM events WHERE event_type = 'error'")
def ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", enrich.expires(F.col("ts")).alias("ttl_expires_at"))
    return e.withColumn("valid", F.col("ttl_expires_at") > F.lit("2024-02-05").cast("timestamp_ntz"))


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("candidate_id"), F.col("c_name").alias("full_name"), F.col("c_mktsegment").alias("current_company"), F.concat(F.lit("Title "), F.col("c_nationkey").cast("string")).alias("current_title"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"), F.array(F.lower("c_mktsegment")).alias("skills"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey") % 3 == 1).alias("open_to_work"),
        (F.col("c_custkey") % 240).alias("experience_months"), F.round(F.col("c_acctbal") / 10000, 3).alias("completeness_score"),
    )


@query(
    "q39_search_page",
    """
WITH p AS (SELECT c_custkey AS candidate_id, c_name AS full_name, c_mktsegment, c_nationkey, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 3 = 1 END AS otw, c_custkey % 240 AS months, round(c_acctbal / 10000, 3) AS score FROM customer),
f AS (SELECT * FROM p WHERE (full_name ILIKE '%customer#%' OR c_mktsegment ILIKE '%customer#%') AND (('Title ' || c_nationkey) ILIKE '%machinery%' OR lower(c_mktsegment) = 'machinery') AND ('city' || c_nationkey) ILIKE '%1%' AND otw = true AND months >= 60)
SELECT candidate_id, full_name, score AS completeness_score, (SELECT count(*) FROM f) AS total FROM f ORDER BY score DESC, candidate_id LIMIT 10 OFFSET 2
""",
)
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    total, page = search(_people(spark, sf_dir), q="customer#", role="MACHINERY", location="1", open_to_work=True, min_experience=5, limit=10, offset=2)
    return page.select("candidate_id", "full_name", "completeness_score", F.lit(total).cast("long").alias("total"))


@query(
    "q40_detail",
    """
WITH l AS (SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS lines FROM lineitem GROUP BY 1)
SELECT c_custkey, c_name, count(*) AS orders, string_agg(o_orderkey || '[' || coalesce(lines, '') || ']', ';' ORDER BY o_orderdate DESC, o_orderkey) AS history FROM customer JOIN orders ON o_custkey = c_custkey LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1, 2
""",
)
def detail_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    line = F.struct("l_linenumber", "l_partkey", F.concat(text("l_linenumber"), F.lit(":"), text("l_partkey")).alias("t"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_list(line))["t"], ",").alias("lines"))
    o = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    order = F.struct((-F.unix_seconds(F.col("o_orderdate").cast("timestamp"))).alias("late"), F.col("o_orderkey"), F.concat(text("o_orderkey"), F.lit("["), F.coalesce("lines", F.lit("")), F.lit("]")).alias("t"))
    per = o.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.array_join(F.array_sort(F.collect_list(order))["t"], ";").alias("history"))
    return table(spark, sf_dir, "customer").join(per, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_name", "orders", "history")


@query("q41_latest_report", "SELECT event_type AS batch, arg_max(event_id, (ts, event_id)) AS run_id, max(ts) AS started_at, arg_max(props, (ts, event_id)) AS report FROM events GROUP BY event_type")
def reports_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_reports(table(spark, sf_dir, "events").select(F.col("event_type").alias("batch"), F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"), F.col("props").alias("report")))


@query(
    "q42_export_rows",
    """
WITH o AS (SELECT o_custkey, count(*) AS n, max(o_orderkey) FILTER (o_orderstatus = 'F') AS primary_order, bool_or(o_orderstatus = 'P') AS pending, list_sort(list(DISTINCT o_orderpriority)) AS p FROM orders GROUP BY 1)
SELECT c_custkey, c_name, printf('%.3f', c_acctbal / 10000) AS score, printf('%.2f', coalesce(n, 0) * 0.09) AS cost, coalesce(array_to_string(p, ';'), '') AS priorities, coalesce(CAST(primary_order AS VARCHAR), '') AS primary_order,
  CASE WHEN coalesce(pending, false) THEN 'true' ELSE 'false' END AS pending, strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(c_custkey AS BIGINT)), '%Y-%m-%dT%H:%M:%S+00:00') AS first_seen_at FROM customer LEFT JOIN o ON o_custkey = c_custkey
""",
)
def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))).alias("primary_order"), F.bool_or(F.col("o_orderstatus") == "P").alias("pending"), F.array_sort(F.collect_set("o_orderpriority")).alias("p")
    )
    c = table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    return c.select(
        "c_custkey", "c_name", fixed(F.col("c_acctbal") / 10000, 3).alias("score"), fixed(F.coalesce("n", F.lit(0)) * F.lit(0.09), 2).alias("cost"), F.coalesce(F.array_join("p", ";"), F.lit("")).alias("priorities"),
        F.coalesce(F.col("primary_order").cast("string"), F.lit("")).alias("primary_order"), F.when(F.coalesce("pending", F.lit(False)), "true").otherwise("false").alias("pending"),
        F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + 60 * F.col("c_custkey")).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("first_seen_at"),
    )


@query(
    "q43_change_order",
    "WITH e AS (SELECT user_id, event_id, CASE WHEN event_type <> 'error' THEN ts END AS applied_at FROM events) SELECT user_id, event_id, applied_at, CAST(row_number() OVER (PARTITION BY user_id ORDER BY applied_at DESC NULLS LAST, event_id) AS INTEGER) AS position FROM e",
)
def change_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("applied_at"))
    return e.withColumn("position", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc_nulls_last("applied_at"), "event_id")))


@query(
    "q44_run_report",
    "SELECT CAST(event_id % 2 AS BIGINT) AS batch, count(*) AS rows_in, count(*) FILTER (event_type = 'error') AS rows_rejected, count(DISTINCT CASE WHEN event_type <> 'error' THEN user_id END) AS entities, count(*) FILTER (event_type = 'signup') AS created, CAST(sum(CASE WHEN event_type = 'purchase' THEN 9 ELSE 0 END) AS BIGINT) AS spend_paise, min(ts) AS started_at, max(ts) AS finished_at FROM events GROUP BY 1",
)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").groupBy((F.col("event_id") % 2).alias("batch")).agg(
        F.count("*").alias("rows_in"), F.count_if(kind == "error").alias("rows_rejected"), F.countDistinct(F.when(kind != "error", F.col("user_id"))).alias("entities"), F.count_if(kind == "signup").alias("created"),
        F.sum(F.when(kind == "purchase", 9).otherwise(0)).alias("spend_paise"), F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"),
    )


@query("q45_stream_replay", _FOLD_RESULT)
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream, read twice (a replay); the fold over what was stored equals the batch fold."""
    base = f"{shared_dir(spark).rstrip('/')}/replay-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    name = f"replayed_{uuid.uuid4().hex}"
    archive = Archive(spark, name, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")), path=f"{base}/stored")
    key = F.sha2(F.to_json(F.struct(*schema.fieldNames())), 256)
    for run in range(2):
        stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*").withColumn("content_hash", key)
        ingest_stream(stream, archive, f"{base}/checkpoint-{run}").awaitTermination()
    return current(fold(observations(archive.table()), ["user_id"]))


@query(
    "q46_dedup_health",
    """
WITH d AS (SELECT date_trunc('day', ts) AS day, count(*) AS rows_in, count(DISTINCT user_id) AS entities FROM events GROUP BY 1), r AS (SELECT day, entities / rows_in AS ratio FROM d)
SELECT day, round(ratio, 6) AS ratio, round(median(ratio) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS median_7d FROM r
""",
)
def dedup_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "events").groupBy(F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("day")).agg((F.countDistinct("user_id") / F.count("*")).alias("ratio"))
    # One row a day: a window over all days is as long as the calendar.
    week = Window.orderBy("day").rowsBetween(-6, 0)
    d = d.withColumn("w", F.array_sort(F.collect_list("ratio").over(week)))
    middle = (F.get("w", F.floor((F.size("w") - 1) / 2).cast("int")) + F.get("w", F.floor(F.size("w") / 2).cast("int"))) / 2
    return d.select("day", F.round("ratio", 6).alias("ratio"), F.round(middle, 6).alias("median_7d"))


@query(
    "q50_postings_search",
    "SELECT p_partkey, p_name, p_type FROM part WHERE p_name ILIKE '%t_g%' OR p_type ILIKE '%t_g%' OR p_name ILIKE '%mall%rin%' OR p_type ILIKE '%mall%rin%' OR p_name ILIKE '%STAND%' OR p_type ILIKE '%STAND%'",
)
def postings_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by substring patterns through an index of n-grams; the first pattern is too short for it and scans."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    path = f"{shared_dir(spark).rstrip('/')}/postings-{uuid.uuid4().hex}"
    fields = ["p_name", "p_type"]
    write_postings(part, "p_partkey", fields, path)
    index = written(spark, path)
    found = [like(part, index, "p_partkey", fields, pattern) for pattern in ("t_g", "mall%rin", "STAND")]
    return found[0].union(found[1]).union(found[2]).distinct()


@query(
    "q51_valid_time",
    _FOLD_SQL
    + """, h AS (SELECT user_id, x.ord AS valid_from, lead(x.ord) OVER (PARTITION BY user_id ORDER BY x.ord) AS valid_to, x.v AS value, x.s AS source FROM s WHERE applied),
m AS (SELECT DISTINCT user_id, ((event_id * 7919) % 1000003) AS "at" FROM events WHERE event_type = 'signup')
SELECT m.user_id, m."at", value, source FROM m JOIN h ON m.user_id = h.user_id AND valid_from <= m."at" AND (valid_to IS NULL OR m."at" < valid_to)""",
)
def valid_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of every user at each of their sign-ups, from the intervals over which values were current."""
    e = table(spark, sf_dir, "events")
    folded = stage(fold(observations(e).withColumn("field", F.lit("k")), ["user_id", "field"]), "folded")
    seen = history(folded, ["user_id", "field"]).withColumnRenamed("user_id", "candidate_id")
    valid = valid_times(seen)
    moments = e.where("event_type = 'signup'").select(F.col("user_id").alias("candidate_id"), F.expr(_ARRIVAL).alias("at")).distinct()
    return values_at(valid, moments).select(F.col("candidate_id").alias("user_id"), "at", "value", "source")


@query(
    "q52_quarantine",
    """
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey, l_suppkey) AS n FROM lineitem),
j AS (SELECT l_quantity > 45 AS quantity, l_discount > 0.09 AS discount, n > 1 AS line, NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P') AS open_order FROM l)
SELECT constraint_name, CAST(n AS BIGINT) AS n FROM (SELECT 'rows' AS constraint_name, count(*) AS n FROM j UNION ALL SELECT 'kept', count(*) FILTER (NOT (quantity OR discount OR line OR open_order)) FROM j
UNION ALL SELECT 'quantity_range', count(*) FILTER (quantity) FROM j UNION ALL SELECT 'discount_range', count(*) FILTER (discount) FROM j UNION ALL SELECT 'unique_line', count(*) FILTER (line) FROM j
UNION ALL SELECT 'order_exists', count(*) FILTER (open_order) FROM j)
""",
)
def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under four constraints, written once; the counts are observed by that write."""
    known = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select("o_orderkey")
    constraints = [
        Check("quantity_range", F.col("l_quantity") <= 45), Check("discount_range", F.col("l_discount") <= 0.09), Unique("unique_line", ("l_orderkey", "l_linenumber"), ("l_extendedprice", "l_partkey", "l_suppkey")),
        Reference("order_exists", "l_orderkey", known),
    ]
    path = f"{shared_dir(spark).rstrip('/')}/quarantine-{uuid.uuid4().hex}"
    counts = write_checked(table(spark, sf_dir, "lineitem"), constraints, path)
    written(spark, path)
    return spark.createDataFrame(sorted(counts.items()), "constraint_name string, n long")


@query("q54_keyed_stream", _FOLD_RESULT.replace("arg_max(x.t, x.ord) AS observed_at, ", ""))
def keyed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream through the fold with keyed state; the last applied step of each user is its value."""
    base = f"{shared_dir(spark).rstrip('/')}/keyed-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    with with_rocksdb(spark):
        steps = fold_stream(observations(stream, "event_id").withColumn("time", F.unix_micros("time")), "user_id", "event_id")
        steps.writeStream.format("parquet").option("path", f"{base}/steps").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    last = written(spark, f"{base}/steps").where("applied").groupBy("key").agg(F.max_by(F.struct("value", "source", "confidence"), "version").alias("s"))
    return last.select(F.col("key").cast("long").alias("user_id"), "s.*")


@query("q53_archive_append", "SELECT event_type, count(*) AS stored FROM events GROUP BY event_type")
def archive_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events into the bucketed archive in three overlapping parts: every content is stored once."""
    e = table(spark, sf_dir, "events")
    rows = e.withColumn("content_hash", F.sha2(F.to_json(F.struct(*e.columns)), 256))
    name = f"archive_{uuid.uuid4().hex}"
    archive = Archive(spark, name, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")), path=f"{shared_dir(spark).rstrip('/')}/{name}")
    for part in (rows.where("event_id % 3 < 2"), rows.where("event_id % 3 > 0"), rows.union(rows)):
        archive.append(part)
    return archive.table().groupBy("event_type").agg(F.count("*").alias("stored"))
