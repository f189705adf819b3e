"""q01 to q15: normalisers, presence, rejection and the union of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions import normalize as N
from kinfold.functions import policy as P
from kinfold.plans.catalogue import query, table

_EMPTY_SQL = ", ".join(f"'{x}'" for x in P.EMPTY)


def _clean_sql(x: str) -> str:
    return f"(CASE WHEN lower(trim(regexp_replace({x}, '\\s+', ' ', 'g'))) NOT IN ({_EMPTY_SQL}) THEN trim(regexp_replace({x}, '\\s+', ' ', 'g')) END)"


_ADDRESS = """CASE CAST(c_custkey % 6 AS INTEGER) WHEN 0 THEN 'A.Person' || (c_custkey % 97) || '+tag@GMAIL.com' WHEN 1 THEN 'a.person' || (c_custkey % 97) || '@googlemail.com'
  WHEN 2 THEN ' First.Last' || (c_custkey % 53) || '@Corp' || (c_custkey % 7) || '.org ' WHEN 3 THEN 'nobody' || c_custkey || '@test.com' WHEN 4 THEN 'N/A' ELSE 'not an address ' || c_custkey END"""


@query(
    "q01_email_identity",
    f"""
WITH raw AS (SELECT c_custkey, {_ADDRESS} AS address FROM customer),
t AS (SELECT c_custkey, lower({_clean_sql('address')}) AS a FROM raw),
p AS (SELECT c_custkey, split_part(split_part(a, '@', 1), '+', 1) AS l, split_part(a, '@', 2) AS d FROM t WHERE regexp_matches(a, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')),
e AS (SELECT c_custkey, l, CASE WHEN d IN ('gmail.com', 'googlemail.com') THEN 'gmail.com' ELSE d END AS d FROM p WHERE d NOT IN ('test.com', 'example.com', 'example.org', 'example.net'))
SELECT CASE WHEN d = 'gmail.com' THEN replace(l, '.', '') ELSE l END || '@' || d AS match_key, min(l || '@' || d) AS display, CASE WHEN d = 'gmail.com' THEN 'personal' ELSE 'work' END AS email_type,
  count(*) AS people, min(c_custkey) AS first_custkey FROM e GROUP BY 1, 3
""",
)
def email_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_ADDRESS.replace("CAST(c_custkey % 6 AS INTEGER)", "CAST(c_custkey % 6 AS INT)")).alias("address"))
    found = raw.select("c_custkey", N.email(F.col("address")).alias("display")).where("display IS NOT NULL")
    found = found.select("c_custkey", "display", N.email_key(F.col("display")).alias("match_key"), N.email_type(F.col("display")).alias("email_type"))
    return found.groupBy("match_key", "email_type").agg(F.min("display").alias("display"), F.count("*").alias("people"), F.min("c_custkey").alias("first_custkey"))


_PHONE = """CASE CAST(c_custkey % 7 AS INTEGER) WHEN 0 THEN '+91-98450-' || lpad(CAST(c_custkey % 100000 AS VARCHAR(9)), 5, '0') WHEN 1 THEN '0' || CAST(9800000000 + c_custkey AS VARCHAR(20))
  WHEN 2 THEN CAST(9700000000 + c_custkey AS VARCHAR(20)) WHEN 3 THEN '+1 (743) 555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR(9)), 4, '0') WHEN 4 THEN '1111111111' WHEN 5 THEN '1234567890' || lpad(CAST(c_custkey AS VARCHAR(20)), 6, '0') ELSE '0091 ' || CAST(9600000000 + c_custkey AS VARCHAR(20)) END"""


@query(
    "q02_phone_e164",
    f"""
WITH raw AS (SELECT c_custkey, {_PHONE} AS phone FROM customer),
a AS (SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace({_clean_sql('phone')}, '[^0-9+]', '', 'g'), '^\\++', ''), '^00', '') AS d FROM raw),
b AS (SELECT c_custkey, CASE WHEN length(d) = 10 THEN '91' || d WHEN length(d) = 11 AND d LIKE '0%' THEN '91' || substr(d, 2) ELSE d END AS d FROM a)
SELECT c_custkey, CASE WHEN length(d) BETWEEN 11 AND 15 AND len(list_distinct(string_split(regexp_replace(d, '^91', ''), ''))) > 1 THEN '+' || d END AS phone FROM b
""",
)
def phone_e164(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_PHONE.replace("AS INTEGER", "AS INT")).alias("phone"))
    return raw.select("c_custkey", N.phone(F.col("phone")).alias("phone"))


@query(
    "q03_url_handle",
    r"""
WITH u AS (SELECT page_id, CASE CAST(page_id % 4 AS INTEGER) WHEN 0 THEN regexp_replace(url, '^https?://[^/]+/', 'https://www.LinkedIn.com/in/') WHEN 1 THEN regexp_replace(url, '^https?://[^/]+/', 'linkedin.com/pub/') WHEN 2 THEN 'https://linkedin.com/in/' ELSE url END AS raw FROM pages),
l AS (SELECT page_id, CASE WHEN lower(raw) LIKE 'http%' THEN lower(raw) ELSE 'https://' || lower(raw) END AS u FROM u),
p AS (SELECT page_id, regexp_extract(u, '^[a-z0-9+.-]*://([^/?#]*)', 1) AS host, regexp_replace(regexp_extract(u, '^[a-z0-9+.-]*://[^/?#]*([^?#;]*)', 1), '/+$', '') AS path FROM l)
SELECT page_id, CASE WHEN contains(host, 'linkedin.com') THEN coalesce(nullif(regexp_replace(regexp_extract(path, '^/in/(.*)$', 1), '^/+', ''), ''),
  'pub-' || nullif(array_to_string(list_filter(string_split(regexp_extract(path, '^/pub/(.*)$', 1), '/'), lambda s: s <> ''), '-'), '')) END AS handle FROM p
""",
)
def url_handle(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    site = lambda prefix: F.regexp_replace("url", "^https?://[^/]+/", prefix)
    raw = F.when(k == 0, site("https://www.LinkedIn.com/in/")).when(k == 1, site("linkedin.com/pub/")).when(k == 2, "https://linkedin.com/in/").otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", N.profile_handle(raw).alias("handle"))


_MESSY = "CASE CAST(p_partkey % 7 AS INTEGER) WHEN 0 THEN ' N/A ' WHEN 1 THEN '-' WHEN 2 THEN '' WHEN 3 THEN 'Not  Disclosed' WHEN 4 THEN '  ' || p_name || '   x ' WHEN 5 THEN NULL ELSE p_brand END"


@query("q04_clean_empty", f"WITH m AS (SELECT p_partkey, {_MESSY} AS raw FROM part), c AS (SELECT {_clean_sql('raw')} AS v FROM m) SELECT v AS value, count(*) AS n, v IS NULL AS empty FROM c GROUP BY v")
def clean_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = table(spark, sf_dir, "part").select(N.clean(F.expr(_MESSY.replace("AS INTEGER", "AS INT"))).alias("value"))
    return cleaned.groupBy("value").agg(F.count("*").alias("n")).withColumn("empty", F.col("value").isNull())


_NAME = "CASE CAST(p_partkey % 4 AS INTEGER) WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', ', ') WHEN 2 THEN 'Mc' || upper(substr(p_name, 1, 1)) || substr(p_name, 2) ELSE p_name || ',' END"


@query(
    "q05_name_case",
    f"""
WITH r AS (SELECT p_partkey, {_clean_sql('raw')} AS n FROM (SELECT p_partkey, {_NAME} AS raw FROM part)),
f AS (SELECT p_partkey, CASE WHEN strpos(n, ',') > 0 AND trim(substr(n, 1, strpos(n, ',') - 1)) <> '' AND trim(substr(n, strpos(n, ',') + 1)) <> '' THEN trim(substr(n, strpos(n, ',') + 1)) || ' ' || trim(substr(n, 1, strpos(n, ',') - 1)) ELSE n END AS n FROM r),
d AS (SELECT p_partkey, array_to_string(list_transform(string_split(n, ' '), lambda w: CASE WHEN w = upper(w) OR w = lower(w) THEN upper(substr(w, 1, 1)) || lower(substr(w, 2)) ELSE w END), ' ') AS display FROM f)
SELECT p_partkey, display, lower(display) AS normalized FROM d
""",
)
def name_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(_NAME.replace("AS INTEGER", "AS INT"))
    return table(spark, sf_dir, "part").select("p_partkey", N.display_name(raw).alias("display")).withColumn("normalized", F.lower("display"))


_PLACE = "CASE CAST(c_custkey % 8 AS INTEGER) WHEN 0 THEN 'Bengaluru, Karnataka, India' WHEN 1 THEN 'Pune, KA' WHEN 2 THEN 'Hyderabad / Bangalore' WHEN 3 THEN 'Remote, India' WHEN 4 THEN 'Remote' WHEN 5 THEN c_mktsegment || ', MH' WHEN 6 THEN 'N/A' ELSE 'BLR, Delhi NCR, TN' END"
_city_map = lambda i: "MAP {" + ", ".join(f"'{k}': '{v[i]}'" for k, v in P.CITIES.items()) + "}"
_state_map = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in P.STATES.items()) + "}"


@query(
    "q06_location_gazetteer",
    f"""
WITH r AS (SELECT c_custkey, {_clean_sql('raw')} AS raw FROM (SELECT c_custkey, {_PLACE} AS raw FROM customer)),
t AS (SELECT c_custkey, raw, list_filter(list_transform(string_split_regex(raw, '[,/]'), lambda x: lower(trim(x))), lambda x: x <> '') AS t FROM r),
s AS (SELECT c_custkey, raw, i, t[i] AS tok FROM t, generate_series(1, 6) g(i) WHERE i <= len(t)),
c AS (SELECT *, {_city_map(0)}[tok] AS city, {_city_map(1)}[tok] AS cstate, {_state_map}[tok] AS abbrev FROM s),
f AS (SELECT c_custkey, min(i) FILTER (city IS NOT NULL) AS first_city FROM c GROUP BY 1),
o AS (SELECT c.c_custkey, max(city) FILTER (i = first_city) AS city,
  arg_max(CASE WHEN i = first_city THEN cstate WHEN city IS NULL THEN abbrev END, i) FILTER (i = first_city OR (city IS NULL AND abbrev IS NOT NULL)) AS state,
  bool_or(tok = 'india' OR abbrev IS NOT NULL OR city IS NOT NULL) AS known FROM c JOIN f USING (c_custkey) GROUP BY 1)
SELECT r.c_custkey, r.raw, o.city, o.state, CASE WHEN o.known OR contains(lower(r.raw), 'india') THEN 'IN' END AS country FROM r LEFT JOIN o USING (c_custkey)
""",
)
def location_gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "customer").select("c_custkey", N.location(F.expr(_PLACE.replace("AS INTEGER", "AS INT"))).alias("p"))
    return found.select("c_custkey", "p.raw", "p.city", "p.state", "p.country")


_SKILLS = "CASE CAST(p_partkey % 3 AS INTEGER) WHEN 0 THEN 'SQL, Powerbi, ' || p_type || ', Advanced Excel, SQL' WHEN 1 THEN replace(p_name, ' ', ',') || ',K8s,py,' ELSE '' END"


@query(
    "q07_skills_alias",
    f"""
WITH r AS (SELECT p_partkey, list_transform(string_split({_SKILLS}, ','), lambda x: lower(trim(x))) AS l FROM part),
m AS (SELECT p_partkey, list_filter(list_transform(l, lambda x: coalesce(MAP {{{', '.join(f"'{k}': '{v}'" for k, v in P.SKILL_ALIASES.items())}}}[x], x)), lambda x: x <> '') AS l FROM r)
SELECT p_partkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ';') AS skills FROM m
""",
)
def skills_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(N.skills(F.split(F.expr(_SKILLS.replace("AS INTEGER", "AS INT")), ",")), ";").alias("skills"))


_EXPERIENCE = "CASE CAST(o_orderkey % 6 AS INTEGER) WHEN 0 THEN (o_orderkey % 19) || ' Years ' || (o_orderkey % 12) || ' Months' WHEN 1 THEN (o_orderkey % 9) || '+' WHEN 2 THEN (o_orderkey % 9) || '.5' WHEN 3 THEN (o_orderkey % 30) || ' months' WHEN 4 THEN (o_orderkey % 7) || '.125' ELSE o_orderpriority END"


@query(
    "q08_experience_months",
    f"""
WITH t AS (SELECT o_orderkey, lower({_clean_sql(_EXPERIENCE)}) AS t FROM orders),
p AS (SELECT o_orderkey, TRY_CAST(nullif(regexp_extract(t, '(\\d+(?:\\.\\d+)?)\\s*(?:years?|yrs?)', 1), '') AS DOUBLE) AS y, TRY_CAST(nullif(regexp_extract(t, '(\\d+(?:\\.\\d+)?)\\s*(?:months?|mos?)', 1), '') AS DOUBLE) AS m,
  TRY_CAST(nullif(regexp_extract(t, '^(\\d+(?:\\.\\d+)?)\\+?$', 1), '') AS DOUBLE) AS n FROM t)
SELECT o_orderkey, CAST(round_even(CASE WHEN y IS NOT NULL OR m IS NOT NULL THEN coalesce(y, 0) * 12 + coalesce(m, 0) ELSE n * 12 END, 0) AS INTEGER) AS months FROM p
""",
)
def experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", N.experience_months(F.expr(_EXPERIENCE.replace("AS INTEGER", "AS INT"))).alias("months"))


_SALARY = "CASE CAST(o_orderkey % 5 AS INTEGER) WHEN 0 THEN (o_orderkey % 60) || '.5 LPA' WHEN 1 THEN (o_orderkey % 200000) || ' per month' WHEN 2 THEN 'INR ' || (o_orderkey % 3000000) WHEN 3 THEN 'Not Disclosed' ELSE (o_orderkey % 90) || ' lakhs' END"


@query(
    "q09_salary_units",
    f"""
WITH t AS (SELECT o_orderkey, lower({_clean_sql(_SALARY)}) AS t FROM orders), p AS (SELECT *, TRY_CAST(nullif(regexp_extract(t, '(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS n FROM t)
SELECT o_orderkey, CAST(round_even(n * CASE WHEN contains(t, 'lpa') OR contains(t, 'lakh') THEN 100000 WHEN contains(t, 'per month') OR contains(t, '/month') OR contains(replace(t, ' ', ''), 'pm') THEN 12 ELSE 1 END, 0) AS BIGINT) AS salary FROM p
""",
)
def salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", N.salary_inr(F.expr(_SALARY.replace("AS INTEGER", "AS INT"))).alias("salary"))


_NOTICE = "CASE CAST(l_linenumber % 5 AS INTEGER) WHEN 0 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR(9)) || ' days' WHEN 1 THEN 'Immediate' WHEN 2 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR(9)) || ' weeks' WHEN 3 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR(9)) || ' months' ELSE '-' END"


@query(
    "q10_notice_days",
    f"""
WITH t AS (SELECT lower({_clean_sql(_NOTICE)}) AS t FROM lineitem), p AS (SELECT t, TRY_CAST(nullif(regexp_extract(t, '(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS n FROM t),
d AS (SELECT CAST(CASE WHEN contains(t, 'immediate') THEN 0 ELSE round_even(n * CASE WHEN contains(t, 'week') THEN 7 WHEN contains(t, 'month') THEN 30 ELSE 1 END, 0) END AS INTEGER) AS days FROM p)
SELECT days, count(*) AS n FROM d GROUP BY days
""",
)
def notice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(N.notice_days(F.expr(_NOTICE.replace("AS INTEGER", "AS INT"))).alias("days")).groupBy("days").agg(F.count("*").alias("n"))


_COMPANY = "CASE CAST(s_suppkey % 6 AS INTEGER) WHEN 0 THEN s_name || ' Software Pvt Ltd' WHEN 1 THEN s_name || ' India' WHEN 2 THEN '@' || s_name WHEN 3 THEN s_name || ' Labs Technologies' WHEN 4 THEN s_name || ' Technologies Labs' ELSE s_name || ' Inc.' END"


def _company_sql() -> str:
    out = f"regexp_replace(lower({_clean_sql(_COMPANY)}), '^@', '')"
    for suffix in P.COMPANY_SUFFIXES:
        out = f"trim(regexp_replace({out}, '{suffix.replace('.', chr(92) + '.')}$', ''))"
    return out


@query("q11_company_key", f"SELECT s_suppkey, nullif({_company_sql()}, '') AS company_key FROM supplier")
def company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", N.company_key(F.expr(_COMPANY.replace("AS INTEGER", "AS INT"))).alias("company_key"))


@query("q12_content_hash_dedupe", "SELECT sha256(text) AS content_hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def content_hash_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("content_hash")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


_PAYLOAD = """CASE CAST(event_id % 4 AS INTEGER) WHEN 0 THEN props WHEN 1 THEN '{"k": null}' WHEN 2 THEN '{"other": 1}' ELSE '{"k": ' END"""


@query(
    "q13_json_presence",
    f"""
WITH p AS (SELECT event_id, {_PAYLOAD} AS j FROM events)
SELECT CASE WHEN NOT json_valid(j) THEN 'unparseable' WHEN NOT json_exists(j, '$.k') THEN 'absent' WHEN json_type(j, '$.k') = 'NULL' THEN 'present_null' ELSE 'present' END AS state,
  count(*) AS n, sum(CASE WHEN json_valid(j) THEN TRY_CAST(json_extract_string(j, '$.k') AS BIGINT) END)::BIGINT AS total FROM p GROUP BY 1
""",
)
def json_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.try_parse_json(F.expr(_PAYLOAD.replace("AS INTEGER", "AS INT")))
    k = F.variant_get(F.col("v"), "$.k", "variant")
    state = F.when(F.col("v").isNull(), "unparseable").when(k.isNull(), "absent").when(F.is_variant_null(k), "present_null").otherwise("present")
    return table(spark, sf_dir, "events").select(v.alias("v")).groupBy(state.alias("state")).agg(F.count("*").alias("n"), F.sum(F.try_variant_get(F.col("v"), "$.k", "bigint")).alias("total"))


@query(
    "q14_reject_histogram",
    """
WITH e AS (SELECT event_id, CASE CAST(event_id % 5 AS INTEGER) WHEN 0 THEN '{' ELSE props END AS j, event_type, user_id FROM events),
r AS (SELECT CASE WHEN NOT json_valid(j) THEN 'unparseable_json' WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 'unknown_source' WHEN user_id % 10 = 0 THEN 'no_usable_identifier' ELSE 'accepted' END AS reason FROM e)
SELECT reason, count(*) AS n FROM r GROUP BY reason
""",
)
def reject_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = F.try_parse_json(F.when(F.col("event_id") % 5 == 0, "{").otherwise(F.col("props")))
    reason = (
        F.when(j.isNull(), "unparseable_json").when(~F.col("event_type").isin("click", "view", "purchase"), "unknown_source").when(F.col("user_id") % 10 == 0, "no_usable_identifier").otherwise("accepted")
    )
    return table(spark, sf_dir, "events").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(
    "q15_source_union",
    """
WITH u AS (
  SELECT 'customer' AS source, c_custkey AS source_row_id, c_name AS name, c_nationkey AS nation, CAST(NULL AS VARCHAR) AS kind FROM customer
  UNION ALL SELECT 'supplier', s_suppkey, s_name, s_nationkey, NULL FROM supplier
  UNION ALL SELECT 'part', p_partkey, p_name, NULL, p_type FROM part)
SELECT source, count(*) AS n, count(nation) AS with_nation, count(kind) AS with_kind, count(DISTINCT name) AS names, min(source_row_id) AS first_row FROM u GROUP BY source
""",
)
def source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda name, *columns: table(spark, sf_dir, name).select(F.lit(name).alias("source"), *columns)
    customer = one("customer", F.col("c_custkey").alias("source_row_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    supplier = one("supplier", F.col("s_suppkey").alias("source_row_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    part = one("part", F.col("p_partkey").alias("source_row_id"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"))
    rows = customer.unionByName(supplier).unionByName(part, allowMissingColumns=True)
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.count("nation").alias("with_nation"), F.count("kind").alias("with_kind"), F.countDistinct("name").alias("names"), F.min("source_row_id").alias("first_row"))
