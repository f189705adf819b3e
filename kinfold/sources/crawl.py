"""Sources: crawl batches (one JSON object a line, three layouts) and the lookup provider's file."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions import normalize as N
from kinfold.functions import policy as P

_IDENTIFIER = "struct<itype: string, value: string, match_key: string, raw_form: string, email_type: string>"
_FIELD = "struct<field: string, value: string, eq: string>"


def read_batches(spark: SparkSession, batches: list[tuple[str, str]]) -> DataFrame:
    """batch_seq, batch, line of every line that isn't blank, of (batch, path) in order; a missing path raises."""
    out = None
    for seq, (batch, path) in enumerate(batches):
        lines = spark.read.text(path).select(F.lit(seq).alias("batch_seq"), F.lit(batch).alias("batch"), F.trim("value").alias("line")).where(F.length("line") > 0)
        out = lines if out is None else out.union(lines)
    return out


def read_provider(spark: SparkSession, path: str) -> DataFrame:
    """lookup_key and the response's fields of a file that is one JSON object by key; keys from ``_`` on are about the file."""
    kind = "map<string, struct<status: string, work_email: string, personal_email: string, mobile: string, current_company: string, current_title: string, confidence: double, last_verified: string>>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)).alias("lookup_key", "r"))
    return rows.where(~F.col("lookup_key").startswith("_")).select("lookup_key", "r.*")


def _text(v: Column, key: str) -> Column:
    """A value as text; numbers in their JSON spelling, null for null, absent and nested ones."""
    return F.try_variant_get(v, f"$.{key}", "string")


def _has(v: Column, key: str) -> Column:
    return F.variant_get(v, f"$.{key}", "variant").isNotNull()


def _kind(v: Column, key: str) -> Column:
    return F.schema_of_variant(F.variant_get(v, f"$.{key}", "variant"))


def _experience(v: Column, key: str) -> Column:
    years, months = (F.coalesce(F.try_variant_get(v, f"$.{key}.{part}", "double"), F.lit(0.0)) for part in ("years", "months"))
    return F.when(_kind(v, key).startswith("OBJECT"), F.bround(years * 12 + months).cast("int")).otherwise(N.experience_months(_text(v, key)))


def _flag(v: Column, key: str) -> Column:
    return F.when(_kind(v, key) == "BOOLEAN", F.try_variant_get(v, f"$.{key}", "boolean"))


def _skills(v: Column, key: str) -> Column:
    listed = F.try_variant_get(v, f"$.{key}", "array<string>")
    return N.skills(F.when(_kind(v, key).startswith("ARRAY"), listed).otherwise(F.split(_text(v, key), ",")))


def _field(v: Column, name: str, key: str, value: Column) -> Column:
    """An observation of a field if the row has the key, null included."""
    return F.when(_has(v, key), F.struct(F.lit(name).alias("field"), value.cast("string").alias("value"), value.cast("string").alias("eq")).cast(_FIELD))


def _place(v: Column, key: str) -> Column:
    """Locations are equal if city, state and country are."""
    place = lambda p: F.struct(F.lit("location").alias("field"), F.when(p["raw"].isNotNull(), F.to_json(p)).alias("value"), F.to_json(F.struct(p["city"].alias("a"), p["state"].alias("b"), p["country"].alias("c"))).alias("eq")).cast(_FIELD)
    return F.when(_has(v, key), N.let(N.location(_text(v, key)), place))


def _identifier(itype: str, raw: Column, value: Column, key: Column | None = None, kind: Column | None = None) -> Column:
    made = F.struct(F.lit(itype).alias("itype"), value.alias("value"), (value if key is None else key).alias("match_key"), F.trim(raw).alias("raw_form"), (F.lit(None).cast("string") if kind is None else kind).alias("email_type"))
    return F.when(value.isNotNull(), made.cast(_IDENTIFIER))


def mail_identifier(raw: Column) -> Column:
    return N.let(N.email(raw), lambda e: _identifier("email", raw, e, N.email_key(e), N.email_type(e)))


def _handle(raw: Column) -> Column:
    return N.let(N.profile_handle(raw), lambda h: _identifier("linkedin_handle", raw, h))


def phone_identifier(raw: Column) -> Column:
    return N.let(N.phone(raw), lambda p: _identifier("phone", raw, p))


@lru_cache(maxsize=4)
def _columns(application: str) -> list[Column]:
    """What a line gives in ``v``; made once an application, for it takes thousands of expressions."""
    v = F.col("v")
    source = _text(v, "_src")
    pick = lambda a, b, c: F.when(source == P.SOURCES[0], a).when(source == P.SOURCES[1], b).when(source == P.SOURCES[2], c)
    title = lambda name, key: _field(v, name, key, N.clean(_text(v, key)))
    login = F.lower(N.clean(_text(v, "login")))
    identifiers = pick(
        F.array(_handle(_text(v, "profile_url")), mail_identifier(_text(v, "email")), phone_identifier(_text(v, "phone"))),
        F.array(_handle(_text(v, "linkedin")), mail_identifier(_text(v, "email_id")), phone_identifier(_text(v, "mobile"))),
        F.array(_identifier("github_login", _text(v, "login"), login), _handle(_text(v, "blog")), mail_identifier(_text(v, "email"))),
    )
    name = lambda key: _field(v, "full_name", key, N.display_name(_text(v, key)))
    fields = pick(
        F.array(name("full_name"), title("current_title", "current_title"), title("current_company", "current_company"), _place(v, "location"), _field(v, "experience_months", "experience_years", _experience(v, "experience_years")), _field(v, "open_to_work", "open_to_work", _flag(v, "open_to_work"))),
        F.array(
            name("candidate_name"), title("current_title", "curr_designation"), title("current_company", "curr_employer"), _place(v, "pref_location"), _field(v, "experience_months", "total_exp", _experience(v, "total_exp")),
            _field(v, "annual_salary_inr", "annual_salary", N.salary_inr(_text(v, "annual_salary"))), _field(v, "notice_period_days", "notice_period", N.notice_days(_text(v, "notice_period"))),
        ),
        F.array(name("name"), _field(v, "current_company", "company", F.regexp_replace(N.clean(_text(v, "company")), "^@", "")), _place(v, "location"), _field(v, "open_to_work", "hireable", _flag(v, "hireable"))),
    )
    return [
        F.col("batch_seq"), F.col("batch"), N.content_hash(F.col("line")).alias("content_hash"), source.alias("source"), F.try_variant_get(v, "$._row", "int").alias("source_row_id"), _text(v, "_crawled_at").alias("crawled_at"), v.isNull().alias("_bad"),
        F.array_compact(identifiers).alias("identifiers"), F.array_compact(fields).alias("fields"), pick(_skills(v, "skills"), _skills(v, "key_skills"), _skills(v, "top_languages")).alias("skills"),
    ]


def records(lines: DataFrame) -> DataFrame:
    """One row a line: batch, batch_seq, content_hash, source, source_row_id, crawled_at, reason (null if accepted), name, identifiers, fields, skills.

    Reasons: ``unparseable_json`` (or no object), ``unknown_source``, ``bad_row`` (no crawl time),
    ``no_usable_identifier``. Of equal contents the first in order stays.
    """
    parsed = lines.withColumn("v", F.try_parse_json("line")).withColumn("v", F.when(F.schema_of_variant("v").startswith("OBJECT"), F.col("v")))
    out = parsed.select(*_columns(lines.sparkSession.sparkContext.applicationId))
    reason = (
        F.when(F.col("_bad"), "unparseable_json").when(~F.coalesce(F.col("source").isin(*P.SOURCES), F.lit(False)), "unknown_source")
        .when(F.try_to_timestamp("crawled_at").isNull(), "bad_row").when(F.size("identifiers") == 0, "no_usable_identifier")
    )
    order = F.struct("batch_seq", F.coalesce("crawled_at", F.lit("")).alias("crawled_at"), F.coalesce("source_row_id", F.lit(0)).alias("source_row_id"), F.col("content_hash"))
    out = out.withColumn("reason", reason).withColumn("ord", order).drop("_bad")
    columns = [c for c in out.columns if c != "content_hash"]
    return out.groupBy("content_hash").agg(F.min_by(F.struct(*columns), "ord").alias("r")).select("content_hash", "r.*")


def observations(accepted: DataFrame) -> DataFrame:
    """One row for each observed field of each accepted row, as the field fold takes them."""
    from kinfold.operators.fold import trust_rank

    confidence = F.create_map(*[F.lit(x) for pair in P.CONFIDENCE.items() for x in pair])
    rows = accepted.select("content_hash", "ord", "source", F.to_timestamp("crawled_at").alias("time"), F.coalesce(confidence[F.col("source")], F.lit(P.DEFAULT_CONFIDENCE)).alias("confidence"), F.explode("fields").alias("f"))
    return rows.select("content_hash", "ord", "source", "time", "confidence", "f.*").withColumn("rank", trust_rank(F.col("field"), F.col("source")))
