"""q16 to q33: identities, matching, components, the field fold and its logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators.components import connected_components
from kinfold.operators import fold as folding
from kinfold.operators.fold import changes, conflicts, fold, history
from kinfold.operators.forest import links, merge_history
from kinfold.operators.prefix import earlier_maximum
from kinfold.plans.catalogue import query, table
from kinfold.storage import stage

_RANKS = {"purchase": 0, "signup": 1, "click": 1, "view": 2, "error": 99}
_ARRIVAL = "(event_id * 7919) % 1000003"


def _k(column: str = "props"):
    return F.get_json_object(column, "$.k").cast("long")


@query(
    "q16_identity_upsert",
    """
WITH e AS (SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_type, k, arg_min(user_id, event_id) AS owner, array_to_string(list_sort(list(DISTINCT user_id % 7)), ';') AS observed_in, max(value) AS confidence, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS observations
FROM e GROUP BY event_type, k
""",
)
def identity_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("k", _k())
    return e.groupBy("event_type", "k").agg(
        F.min_by("user_id", "event_id").alias("owner"), F.array_join(F.array_sort(F.collect_set(F.col("user_id") % 7)).cast("array<string>"), ";").alias("observed_in"), F.max("value").alias("confidence"),
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("observations"),
    )


@query(
    "q17_strong_match",
    """
WITH i AS (SELECT c_custkey AS owner, 'phone' AS itype, c_custkey % 500 AS match_key FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, 'email', c_custkey % 700 FROM customer),
o AS (SELECT o_orderkey, 'phone' AS itype, o_custkey % 500 AS match_key FROM orders UNION ALL SELECT o_orderkey, 'email', o_custkey % 700 FROM orders),
m AS (SELECT o_orderkey, CASE itype WHEN 'email' THEN 1 ELSE 2 END AS strength, itype, min(owner) AS owner, count(DISTINCT owner) AS owners FROM o JOIN i USING (itype, match_key) GROUP BY 1, 2, 3)
SELECT o_orderkey, arg_min(itype, strength) || '_exact' AS rule, arg_min(owner, strength) AS owner, CAST(sum(owners) AS BIGINT) AS hits FROM m GROUP BY o_orderkey
""",
)
def strong_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    def identifiers(df: DataFrame, row: str, key: str, phone) -> DataFrame:
        each = F.array(F.when(phone, F.struct(F.lit("phone").alias("itype"), (F.col(key) % 500).alias("match_key"))), F.struct(F.lit("email").alias("itype"), (F.col(key) % 700).alias("match_key")))
        return df.select(F.col(row), F.explode(F.array_compact(each)).alias("i")).select(row, "i.*")

    known = identifiers(table(spark, sf_dir, "customer").withColumn("owner", F.col("c_custkey")), "owner", "c_custkey", F.col("c_custkey") % 3 != 0)
    rows = identifiers(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", F.lit(True))
    # Owners are counted by key before the join, so that it makes one row an identifier.
    owners = known.groupBy("itype", "match_key").agg(F.min("owner").alias("owner"), F.countDistinct("owner").alias("owners"))
    hits = rows.join(owners, ["itype", "match_key"])
    strength = F.when(F.col("itype") == "email", 1).otherwise(2)
    return hits.groupBy("o_orderkey").agg(F.concat(F.min_by("itype", strength), F.lit("_exact")).alias("rule"), F.min_by("owner", strength).alias("owner"), F.sum("owners").alias("hits"))


@query(
    "q18_combination_unique",
    """
WITH c AS (SELECT c_custkey, c_nationkey, c_mktsegment, CAST(floor(c_acctbal / 100) AS BIGINT) AS bucket FROM customer),
p AS (SELECT a.c_custkey AS row_key, min(b.c_custkey) AS match_key, count(*) AS hits FROM c a JOIN c b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND a.bucket = b.bucket AND a.c_custkey <> b.c_custkey GROUP BY 1)
SELECT row_key, match_key FROM p WHERE hits = 1
""",
)
def combination_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.floor(F.col("c_acctbal") / 100).alias("bucket"))
    keys = ["c_nationkey", "c_mktsegment", "bucket"]
    # One other match means a group of two: grouping finds it without pairs.
    pairs = c.groupBy(*keys).agg(F.count("*").alias("n"), F.min("c_custkey").alias("a"), F.max("c_custkey").alias("b")).where("n = 2")
    return pairs.select(F.explode(F.array(F.struct(F.col("a").alias("row_key"), F.col("b").alias("match_key")), F.struct(F.col("b").alias("row_key"), F.col("a").alias("match_key")))).alias("p")).select("p.*")


@query(
    "q19_same_name_collision",
    "WITH f AS (SELECT p_name, min(p_partkey) AS first_key FROM part GROUP BY p_name) SELECT p.p_partkey AS row_key, f.first_key AS collides_with, p.p_name AS name FROM part p JOIN f USING (p_name) WHERE p.p_partkey <> f.first_key",
)
def same_name_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    first = p.groupBy("p_name").agg(F.min("p_partkey").alias("collides_with"))
    return p.join(first, "p_name").where("p_partkey <> collides_with").select(F.col("p_partkey").alias("row_key"), "collides_with", F.col("p_name").alias("name"))


_COMPONENTS_SQL = """
WITH RECURSIVE e AS (SELECT DISTINCT 'u' || lpad(CAST(user_id AS VARCHAR), 12, '0') AS a, 'k' || json_extract_string(props, '$.k') AS b FROM events WHERE event_type = 'purchase' AND value > 200),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT DISTINCT a AS node, a AS reach FROM s UNION SELECT r.node, s.b FROM r JOIN s ON r.reach = s.a),
c AS (SELECT node, min(reach) AS component FROM r GROUP BY node)
"""


def _purchase_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("event_type = 'purchase' AND value > 200")
    user = F.concat(F.lit("u"), F.lpad(F.col("user_id").cast("string"), 12, "0"))
    return connected_components(e.select(user.alias("a"), F.concat(F.lit("k"), _k().cast("string")).alias("b")))


@query("q20_components", _COMPONENTS_SQL + "SELECT node, component FROM c")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _purchase_components(spark, sf_dir)


@query(
    "q21_survivor",
    _COMPONENTS_SQL
    + """, u AS (SELECT CAST(substr(node, 2) AS BIGINT) AS user_id, component FROM c WHERE node LIKE 'u%'), f AS (SELECT user_id, min(ts) AS first_seen FROM events GROUP BY 1)
SELECT component, arg_min(user_id, (first_seen, user_id)) AS survivor, min(first_seen) AS first_seen, count(*) AS members FROM u JOIN f USING (user_id) GROUP BY component""",
)
def survivor(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _purchase_components(spark, sf_dir).where(F.col("node").startswith("u")).select(F.substr("node", F.lit(2)).cast("long").alias("user_id"), "component")
    first = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("first_seen"))
    return users.join(first, "user_id").groupBy("component").agg(F.min_by("user_id", F.struct("first_seen", "user_id")).alias("survivor"), F.min("first_seen").alias("first_seen"), F.count("*").alias("members"))


#: Of all events; the recursion goes over keys alone, since a component's smallest node is a key.
_ALL_COMPONENTS_SQL = """
WITH RECURSIVE e AS (SELECT DISTINCT 'u' || lpad(CAST(user_id AS VARCHAR), 12, '0') AS a, 'k' || json_extract_string(props, '$.k') AS b FROM events),
s AS (SELECT DISTINCT x.b AS a, y.b FROM e x JOIN e y ON x.a = y.a),
r AS (SELECT DISTINCT b AS node, b AS reach FROM e UNION SELECT r.node, s.b FROM r JOIN s ON r.reach = s.a),
k AS (SELECT node, min(reach) AS component FROM r GROUP BY node)
SELECT node, component FROM k UNION SELECT e.a, k.component FROM e JOIN k ON e.b = k.node
"""


@query("q47_components_all", _ALL_COMPONENTS_SQL)
def components_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q20_components without its filter: users and keys of every event."""
    user = F.concat(F.lit("u"), F.lpad(F.col("user_id").cast("string"), 12, "0"))
    return connected_components(table(spark, sf_dir, "events").select(user.alias("a"), F.concat(F.lit("k"), _k().cast("string")).alias("b")))


@query(
    "q49_survivor_all",
    _ALL_COMPONENTS_SQL.replace("SELECT node, component FROM k UNION SELECT e.a, k.component FROM e JOIN k ON e.b = k.node", "")
    + """, u AS (SELECT DISTINCT CAST(substr(e.a, 2) AS BIGINT) AS user_id, k.component FROM e JOIN k ON e.b = k.node), f AS (SELECT user_id, min(ts) AS first_seen FROM events GROUP BY 1)
SELECT component, arg_min(user_id, (first_seen, user_id)) AS survivor, min(first_seen) AS first_seen, count(*) AS members FROM u JOIN f USING (user_id) GROUP BY component""",
)
def survivor_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q21_survivor over the components of every event."""
    users = components_all(spark, sf_dir).where(F.col("node").startswith("u")).select(F.substr("node", F.lit(2)).cast("long").alias("user_id"), "component")
    first = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("first_seen"))
    return users.join(first, "user_id").groupBy("component").agg(F.min_by("user_id", F.struct("first_seen", "user_id")).alias("survivor"), F.min("first_seen").alias("first_seen"), F.count("*").alias("members"))


@query("q48_merge_events")
def merge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in order of arrival as rows with two identifiers, user and key: which entities became one, and at which event."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("node"), F.expr(_ARRIVAL).alias("ord"), F.col("ts").cast("timestamp").alias("time"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("u"), F.concat(F.lit("k"), _k().cast("string")).alias("k"))
    e = stage(e, "events")
    edges = stage(links(e, e.select("node", F.explode(F.array("u", "k")).alias("key"))), "links")
    parts = connected_components(edges)
    rows = stage(e.join(parts, "node", "left").select("node", "ord", "time", F.coalesce("component", "node").alias("entity")), "rows")
    return merge_history(rows, edges)[1].select("survivor", "loser", "ord", F.col("node").alias("event_id"))


def observations(events: DataFrame, *more: str) -> DataFrame:
    """Events as observations of one field of their user, with the columns ``more``; small values say nothing."""
    rank = F.create_map(*[F.lit(x) for pair in _RANKS.items() for x in pair])
    bucket = F.floor(_k() / 25).cast("string")
    value = F.when(F.col("value") >= 5, bucket)
    return events.select(
        "user_id", F.expr(_ARRIVAL).alias("ord"), value.alias("value"), value.alias("eq"), F.col("event_type").alias("source"), F.date_trunc("day", F.col("ts").cast("timestamp")).alias("time"), F.col("value").alias("confidence"), rank[F.col("event_type")].alias("rank"), *more,
    )


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold(observations(table(spark, sf_dir, "events")), ["user_id"])


_FOLD_SQL = f"""
WITH o AS (SELECT user_id, {{'ord': {_ARRIVAL}, 'v': CASE WHEN value >= 5 THEN CAST(CAST(floor(CAST(json_extract_string(props, '$.k') AS BIGINT) / 25.0) AS BIGINT) AS VARCHAR) END, 's': event_type, 't': date_trunc('day', ts), 'c': value,
  'r': CASE event_type {' '.join(f"WHEN '{k}' THEN {v}" for k, v in _RANKS.items())} END}} AS x FROM events),
l AS (SELECT user_id, list_prepend({{'ord': -1::BIGINT, 'v': NULL::VARCHAR, 's': NULL::VARCHAR, 't': NULL::TIMESTAMP, 'c': NULL::DOUBLE, 'r': NULL::INTEGER}}, list(x ORDER BY x.ord)) AS l FROM o GROUP BY user_id),
p AS (SELECT user_id, i, l[i] AS x, list_reduce(l[1:i - 1], lambda a, b: CASE WHEN b.v IS NULL THEN a WHEN a.v IS NULL THEN b WHEN a.v = b.v THEN a WHEN b.r < a.r THEN b WHEN b.r > a.r THEN a
  WHEN b.t > a.t THEN b WHEN b.t < a.t THEN a WHEN b.c > a.c THEN b ELSE a END) AS a FROM l, LATERAL (SELECT unnest(range(2, len(l) + 1)) AS i)),
q AS (SELECT user_id, i, x, a, CASE WHEN x.v IS NULL THEN CASE WHEN a.v IS NOT NULL THEN 'REJECTED:null_from_source_is_not_deletion' END WHEN a.v IS NULL THEN 'fill_value' WHEN a.v = x.v THEN NULL WHEN x.r <> a.r THEN 'source_trust'
    WHEN x.t > a.t THEN CASE WHEN x.s = a.s THEN 'newer_observation_same_source' ELSE 'recency' END WHEN x.t < a.t THEN 'recency' WHEN x.c > a.c THEN 'confidence' ELSE 'incumbent_kept' END AS rule FROM p),
s AS (SELECT *, rule = 'fill_value' OR (x.v IS NOT NULL AND a.v IS NOT NULL AND a.v <> x.v AND (x.r < a.r OR (x.r = a.r AND (x.t > a.t OR (x.t = a.t AND x.c > a.c))))) AS applied, x.v IS NOT NULL AND a.v IS NOT NULL AND a.v <> x.v AS conflict FROM q WHERE rule IS NOT NULL)
"""

_FOLD_RESULT = _FOLD_SQL + "SELECT user_id, arg_max(x.v, x.ord) AS value, arg_max(x.s, x.ord) AS source, arg_max(x.t, x.ord) AS observed_at, arg_max(x.c, x.ord) AS confidence FROM s WHERE applied GROUP BY user_id"


def current(folded: DataFrame) -> DataFrame:
    return folding.current(folded, ["user_id"]).select("user_id", F.col("current.value").alias("value"), F.col("current.source").alias("source"), F.col("current.time").cast("timestamp_ntz").alias("observed_at"), F.col("current.confidence").alias("confidence"))


@query("q22_field_fold", _FOLD_RESULT)
def field_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(_folded(spark, sf_dir))


@query(
    "q23_fold_history",
    _FOLD_SQL + "SELECT user_id, CAST(row_number() OVER w - 1 AS INTEGER) AS version, x.v AS value, x.s AS source, rule, lead(rule) OVER w AS superseded_by, lead(rule) OVER w IS NULL AS is_current FROM s WHERE applied WINDOW w AS (PARTITION BY user_id ORDER BY x.ord)",
)
def fold_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(_folded(spark, sf_dir), ["user_id"]).select("user_id", "version", F.col("observation.value").alias("value"), F.col("observation.source").alias("source"), "rule", "superseded_by", "is_current")


@query("q24_change_log", _FOLD_SQL + "SELECT user_id, x.ord AS ord, rule, a.v AS old_value, x.v AS new_value, x.s AS source, applied FROM s WHERE applied OR rule LIKE 'REJECTED%'")
def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(_folded(spark, sf_dir), ["user_id"]).select("user_id", "ord", "rule", F.col("old.value").alias("old_value"), F.col("new.value").alias("new_value"), F.col("new.source").alias("source"), "applied")


@query("q25_conflict_counts", _FOLD_SQL + "SELECT rule, CASE WHEN applied THEN x.s ELSE a.s END AS winner, CASE WHEN applied THEN a.s ELSE x.s END AS loser, count(*) AS n FROM s WHERE conflict GROUP BY ALL")
def conflict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conflicts(_folded(spark, sf_dir), ["user_id"]).groupBy("rule", "winner", "loser").agg(F.count("*").alias("n"))


@query("q26_null_protection", _FOLD_SQL + "SELECT user_id, count(*) AS nulls_ignored, count(DISTINCT a.v) AS values_kept FROM s WHERE rule LIKE 'REJECTED%' GROUP BY user_id")
def null_protection(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = changes(_folded(spark, sf_dir), ["user_id"]).where(F.col("rule").startswith("REJECTED"))
    return refused.groupBy("user_id").agg(F.count("*").alias("nulls_ignored"), F.countDistinct("old.value").alias("values_kept"))


@query(
    "q27_skills_union",
    "WITH e AS (SELECT user_id, event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) SELECT user_id, array_to_string(list_sort(list(DISTINCT k)), ';') AS skills, count(DISTINCT k) AS n, count(DISTINCT CASE WHEN event_id % 2 = 1 THEN k END) AS second_source FROM e GROUP BY user_id",
)
def skills_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = table(spark, sf_dir, "events").withColumn("k", _k()).groupBy("user_id").agg(F.collect_set(F.when(F.col("event_id") % 2 == 0, F.col("k"))).alias("a"), F.collect_set(F.when(F.col("event_id") % 2 == 1, F.col("k"))).alias("b"))
    union = F.array_sort(F.array_union("a", "b"))
    return sets.select("user_id", F.array_join(union.cast("array<string>"), ";").alias("skills"), F.size(union).cast("long").alias("n"), (F.size(F.array_except("b", "a")) + F.size(F.array_intersect("b", "a"))).cast("long").alias("second_source"))


@query(
    "q28_out_of_order",
    f"WITH e AS (SELECT user_id, ts, max(ts) OVER (PARTITION BY user_id ORDER BY {_ARRIVAL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM events) SELECT user_id, count(*) AS n, count(*) FILTER (ts < seen) AS out_of_order FROM e GROUP BY user_id",
)
def out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = earlier_maximum(table(spark, sf_dir, "events").select("user_id", "ts", F.expr(_ARRIVAL).alias("arrival")), "user_id", "arrival", "ts")
    return e.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("ts") < F.col("earlier")).alias("out_of_order"))


@query("q29_seen_window", "SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(DISTINCT event_type) AS source_count FROM events GROUP BY user_id")
def seen_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.countDistinct("event_type").alias("source_count"))


@query(
    "q30_canonical_pick",
    "SELECT user_id, event_type, arg_max(event_id, (CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) < 50 THEN 1 ELSE 0 END, value, -event_id)) AS event_id FROM events GROUP BY user_id, event_type",
)
def canonical_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.struct(F.when(_k() < 50, 1).otherwise(0).alias("work"), F.col("value"), (-F.col("event_id")).alias("early"))
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.max_by("event_id", best).alias("event_id"))


@query(
    "q31_completeness",
    """
WITH o AS (SELECT o_custkey, count(*) AS n, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS f, max(o_totalprice) AS top FROM orders GROUP BY 1),
s AS (SELECT c_custkey, (CASE WHEN c_name <> '' THEN 1 ELSE 0 END) + (CASE WHEN c_nationkey <> 0 THEN 1 ELSE 0 END) + (CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) + (CASE WHEN c_mktsegment <> '' THEN 1 ELSE 0 END)
  + (CASE WHEN coalesce(n, 0) <> 0 THEN 1 ELSE 0 END) + (CASE WHEN coalesce(f, 0) <> 0 THEN 1 ELSE 0 END) + (CASE WHEN coalesce(top, 0) > 400000 THEN 1 ELSE 0 END) AS filled FROM customer LEFT JOIN o ON o_custkey = c_custkey)
SELECT c_custkey, CAST(filled AS INTEGER) AS filled, round(filled / 7.0, 3) AS completeness FROM s
""",
)
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.max("o_totalprice").alias("top"))
    c = table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    signals = [F.col("c_name") != "", F.col("c_nationkey") != 0, F.col("c_acctbal") > 0, F.col("c_mktsegment") != "", F.col("n") != 0, F.col("f") != 0, F.col("top") > 400_000]
    filled = sum((F.when(s, 1).otherwise(0) for s in signals), F.lit(0))
    return c.select("c_custkey", filled.cast("int").alias("filled")).withColumn("completeness", F.round(F.col("filled") / 7.0, 3))


@query(
    "q32_updated_noop",
    _FOLD_SQL + ", n AS (SELECT user_id, count(*) FILTER (applied AND rule <> 'fill_value') AS updates FROM s GROUP BY user_id) SELECT count(*) FILTER (updates > 0) AS updated, count(*) FILTER (updates = 0) AS unchanged, CAST(sum(updates) AS BIGINT) AS fields_changed FROM n",
)
def updated_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = F.count_if(F.col("applied") & (F.col("rule") != "fill_value"))
    n = _folded(spark, sf_dir).groupBy("user_id").agg(updates.alias("updates"))
    return n.agg(F.count_if(F.col("updates") > 0).alias("updated"), F.count_if(F.col("updates") == 0).alias("unchanged"), F.sum("updates").alias("fields_changed"))


@query("q33_merge_groups", "SELECT min(doc_id) AS first_doc, array_to_string(list_sort(list(doc_id)), ',') AS rows, count(*) AS n FROM documents GROUP BY sha256(text) HAVING count(*) > 1")
def merge_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("first_doc"), F.array_sort(F.collect_list("doc_id")).alias("rows"), F.count("*").alias("n")).where("n > 1")
    return grouped.select("first_doc", F.array_join(F.col("rows").cast("array<string>"), ",").alias("rows"), "n")
