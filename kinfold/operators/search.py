"""Read-only queries over the merged state: search, detail, latest report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators import postings


#: Fields of a candidate that are searched as texts.
SEARCHED = ("full_name", "current_company", "current_title", "city")


class NotFound(LookupError):
    """No such record, or no report yet."""


def search(candidates: DataFrame, *, q: str | None = None, role: str | None = None, location: str | None = None, open_to_work: bool | None = None, min_experience: int | None = None, limit: int = 50, offset: int = 0, index: DataFrame | None = None) -> tuple[int, DataFrame]:
    """(total, page): optional conditions joined by AND, best score first, then id.

    Text is matched as a substring, case-insensitive; ``%`` and ``_`` in it are wildcards. A null
    ``open_to_work`` equals neither true nor false. ``min_experience`` is in years. With ``index`` (``postings`` of ``SEARCHED``)
    texts are looked up by their n-grams instead of scanned for.
    """
    if not 1 <= limit <= 200 or offset < 0:
        raise ValueError("1 <= limit <= 200 and 0 <= offset")
    like = lambda column, text: F.col(column).ilike(f"%{text}%")
    conditions: list[Column] = []
    texts = [(q, ["full_name", "current_company"], None), (role, ["current_title"], None if role is None else F.array_contains("skills", role.lower())), (location, ["city"], None)]
    for text, fields, other in texts:
        if text is None:
            continue
        if index is not None:
            candidates = postings.like(candidates, index, "candidate_id", fields, text, other=other)
        else:
            conditions.append(reduce(lambda a, b: a | b, [*[like(f, text) for f in fields], *([] if other is None else [other])]))
    if open_to_work is not None:
        conditions.append(F.col("open_to_work") == open_to_work)
    if min_experience is not None:
        conditions.append(F.col("experience_months") >= 12 * min_experience)
    found = candidates.where(reduce(lambda a, b: a & b, conditions, F.lit(True)))
    return found.count(), found.orderBy(F.col("completeness_score").desc(), "candidate_id").offset(offset).limit(limit)


def _iso(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ssxxx")


def _crawled(ord_: str = "ord") -> Column:
    """The time of the row that an order belongs to (look-ups carry a mark before theirs)."""
    return F.try_to_timestamp(F.regexp_replace(F.col(f"{ord_}.crawled_at"), "^~", ""))


def shape(candidates: DataFrame) -> DataFrame:
    """Records as they are served: place nested, score as a double, no null lists, ISO times."""
    empty = F.array().cast("array<string>")
    place = F.struct("city", "state", "country").alias("location")
    listed = [F.coalesce(c, empty).alias(c) for c in ("skills", "data_quality_flags")]
    return candidates.select(
        "candidate_id", "full_name", "current_title", "current_company", place, "experience_months", "annual_salary_inr", "notice_period_days", listed[0], "open_to_work", "contactable",
        F.col("completeness_score").cast("double").alias("completeness_score"), "source_count", "identity_count", _iso(F.col("first_seen_at")).alias("first_seen_at"), _iso(F.col("last_seen_at")).alias("last_seen_at"), listed[1],
    )


def identity_list(identities: DataFrame) -> DataFrame:
    """candidate_id and the lists identities (by type, canonical first), emails, phones."""
    item = F.struct(
        F.col("itype").alias("type"), (~F.col("is_canonical")).alias("other"), F.col("first_ord").alias("since"), "value", F.col("is_canonical").alias("canonical"), "observed_in", "raw_forms",
        _iso(_crawled("first_ord")).alias("first_seen"), "email_type", F.col("latest_source").alias("source"), F.col("confidence").cast("double").alias("confidence"),
    )
    pick = lambda *names: lambda x: F.struct(*[x[n].alias(a) for n, a in names])
    same = lambda *names: [(n, n) for n in names]
    found = identities.groupBy("candidate_id").agg(F.sort_array(F.collect_list(item)).alias("_i"))
    of = lambda kind: F.filter("_i", lambda x: x["type"] == kind)
    return found.select(
        "candidate_id", F.transform("_i", pick(*same("type", "value", "canonical", "observed_in", "raw_forms", "first_seen"))).alias("identities"),
        F.transform(of("email"), pick(("value", "value"), ("email_type", "type"), ("source", "source"), ("confidence", "confidence"))).alias("emails"), F.transform(of("phone"), pick(*same("value", "source", "confidence"))).alias("phones"),
    )


def provenance_map(provenance: DataFrame) -> DataFrame:
    """candidate_id and field_provenance: by field the current observation, with what it superseded, newest first."""
    o = F.col("observation")
    seen = provenance.select("candidate_id", "field", "is_current", "version", "superseded_by", o["value"].alias("value"), o["source"].alias("source"), o["ord"]["source_row_id"].alias("source_row"), o["time"].alias("time"), o["confidence"].alias("confidence"), "rule")
    late = F.struct((-F.unix_micros("time")).alias("late"), (-F.col("version")).alias("last"), "value", "source", _iso(F.col("time")).alias("observed_at"), F.col("superseded_by").alias("reason"))
    per = seen.groupBy("candidate_id", "field").agg(
        F.max(F.when(F.col("is_current"), F.struct("value", "source", "source_row", _iso(F.col("time")).alias("observed_at"), "confidence", F.col("rule").alias("note")))).alias("c"),
        F.sort_array(F.collect_list(F.when(~F.col("is_current"), late))).alias("s"),
    )
    old = F.transform("s", lambda x: F.struct(x["value"].alias("value"), x["source"].alias("source"), x["observed_at"].alias("observed_at"), x["reason"].alias("reason")))
    entry = F.struct("field", F.struct("c.*", old.alias("superseded")).alias("entry"))
    return per.where("c IS NOT NULL").groupBy("candidate_id").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("field_provenance"))


def change_list(change_log: DataFrame) -> DataFrame:
    """candidate_id and change_log, the latest first; refused changes, which were never applied, last."""
    time = F.when(F.col("applied"), _crawled())
    event = F.concat_ws("|", "candidate_id", "field", F.to_json("ord"))
    item = F.struct(
        time.isNull().alias("refused"), (-F.unix_micros(time)).alias("late"), F.col("field"), F.concat(F.lit("evt_"), F.substr(F.sha2(event, 256), F.lit(1), F.lit(26))).alias("event_id"), "old_value", "new_value", "source",
        F.col("ord.source_row_id").alias("source_row"), "batch", _iso(time).alias("applied_at"), "rule",
    )
    names = ("event_id", "field", "old_value", "new_value", "source", "source_row", "batch", "applied_at", "rule")
    return change_log.groupBy("candidate_id").agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: F.struct(*[x[n].alias(n) for n in names])).alias("change_log"))


def details(candidates: DataFrame, identities: DataFrame, provenance: DataFrame, change_log: DataFrame) -> DataFrame:
    """Every record with its identities, e-mails, phones, provenance by field and change log; a record's own lists are one row."""
    own = candidates.select("candidate_id", "normalized_name", "location_raw")
    out = shape(candidates).join(own, "candidate_id").withColumn("location", F.struct(F.col("location_raw").alias("raw"), "location.*")).drop("location_raw")
    for part in (identity_list(identities), provenance_map(provenance), change_list(change_log)):
        out = out.join(part, "candidate_id", "left")
    return out


def detail(candidate_id: str, candidates: DataFrame, identities: DataFrame, provenance: DataFrame, change_log: DataFrame) -> DataFrame:
    """``details`` of one record, from the tables that ``people.build`` gives."""
    mine = [t.where(F.col("candidate_id") == candidate_id) for t in (candidates, identities, provenance, change_log)]
    if mine[0].isEmpty():
        raise NotFound(candidate_id)
    return details(*mine)


def latest_reports(reports: DataFrame) -> DataFrame:
    """The latest report of each batch, by start and then run_id."""
    last = F.struct("started_at", "run_id")
    return reports.groupBy("batch").agg(*[F.max_by(c, last).alias(c) for c in reports.columns if c != "batch"])


def latest_report(reports: DataFrame, batch: str | None = None) -> DataFrame:
    """The latest report, of one batch or of all."""
    found = latest_reports(reports if batch is None else reports.where(F.col("batch") == batch)).orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(1)
    if found.isEmpty():
        raise NotFound(batch or "report")
    return found
