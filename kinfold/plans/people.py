"""From crawl batches to one row a person, with provenance, change log, metrics and report."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.functions import normalize as N
from kinfold.functions import policy as P
from kinfold.operators import enrich
from kinfold.operators.forest import links, merge_history
from kinfold.operators.fold import changes, conflicts, current, fold, history, trust_rank
from kinfold.operators.prefix import earlier_maximum
from kinfold.operators.resolve import resolve
from kinfold.sources.crawl import mail_identifier as _mail
from kinfold.sources.crawl import observations, read_batches, records
from kinfold.sources.crawl import phone_identifier as _phone
from kinfold.storage import shared_dir, stage


@dataclass
class People:
    """The derived tables of all batches so far."""

    records: DataFrame
    rows: DataFrame  # accepted rows with entity, rule, outcome
    candidates: DataFrame
    identities: DataFrame
    provenance: DataFrame
    change_log: DataFrame
    conflicts: DataFrame
    declined: DataFrame
    merged: DataFrame  # survivor, loser, ord, row: when two candidates became one
    folded: DataFrame


def build(spark: SparkSession, batches: list[tuple[str, str]], cache: DataFrame | None = None) -> People:
    """Derive everything from the batches: replaying one changes nothing.

    ``cache`` holds what ``look_up`` returned so far. Its found responses join the identifiers and the fields after
    the batch that they followed; they take no part in matching rows.
    """
    rec = stage(records(read_batches(spark, batches)), "records")
    return derive(rec, rec.where("reason IS NULL"), cache)


def derive(rec: DataFrame, accepted: DataFrame, cache: DataFrame | None = None, owners: DataFrame | None = None, namesakes: DataFrame | None = None) -> People:
    """The tables of ``accepted`` rows, which hold whole entities and whole blocks of entities that a combination may join.

    ``owners`` (itype, match_key, candidate_id, ord) and ``namesakes`` (as of ``namesakes_of``) are what other entities hold of the
    identifiers that look-ups gave, and of the names.
    """
    linked = stage(accepted.join(resolve(accepted), "content_hash"), "linked")
    nodes = linked.select(F.col("content_hash").alias("node"), "ord", F.to_timestamp("crawled_at").alias("time"), "entity")
    keys = linked.select(F.col("content_hash").alias("node"), F.explode("identifiers").alias("i")).select("node", F.concat("i.itype", F.lit(":"), "i.match_key").alias("key"))
    combined = linked.where("via IS NOT NULL").select(F.col("via").alias("a"), F.col("content_hash").alias("b"), F.col("ord").alias("w"))
    joined, merged, final = merge_history(nodes, links(nodes, keys).union(combined))
    identity = lambda c: N.deterministic_id("cand_", F.col(c))
    named = nodes.select(F.col("node"), F.col("ord").alias("created_ord"))
    first = final.join(named.withColumnRenamed("node", "survivor"), "survivor").select("entity", "created_ord")
    linked = linked.join(joined.withColumnRenamed("node", "content_hash"), "content_hash").join(first, "entity")
    linked = stage(linked.withColumns({"created": (F.col("joined") == 0), "candidate_id": identity("created_ord")}), "rows")
    whose = lambda c: named.select(F.col("node").alias(c), identity("created_ord").alias(f"{c}_id"))
    rows_of = linked.select(F.col("content_hash").alias("node"), "batch", F.col("source_row_id").alias("row"), "candidate_id")
    merged = stage(merged.join(whose("survivor"), "survivor").join(whose("loser"), "loser").join(rows_of, "node").select(F.col("survivor_id").alias("survivor"), F.col("loser_id").alias("loser"), "ord", "batch", "row", "candidate_id"), "merged")
    if cache is not None:
        # Look-ups of a candidate that was merged later belong to the survivor.
        later = merged.select(F.col("loser").alias("candidate_id"), F.col("candidate_id").alias("_now"))
        cache = cache.join(later, "candidate_id", "left").withColumn("candidate_id", F.coalesce("_now", "candidate_id")).drop("_now")
    identities = _identities(linked, cache, owners)
    # The strongest identifier that an earlier row of the entity already had names the rule.
    strength = F.array_position(F.array(*map(F.lit, P.IDENTIFIER_STRENGTH)), F.col("itype"))
    held = linked.select("candidate_id", "content_hash", "ord", F.explode("identifiers").alias("i")).select("candidate_id", "content_hash", "ord", "i.itype", "i.match_key")
    known = held.join(identities.select("candidate_id", "itype", "match_key", "first_ord"), ["candidate_id", "itype", "match_key"]).where(F.col("first_ord") < F.col("ord"))
    rule = known.groupBy("content_hash").agg(F.concat(F.min_by("itype", strength), F.lit("_exact")).alias("strong"))
    rows = linked.join(rule, "content_hash", "left").withColumn(
        "rule", F.when(F.col("created"), None).when(F.col("combined"), "name_company_location").otherwise(F.coalesce("strong", F.lit("entity_merge")))
    )
    rows = rows.withColumn("outcome", F.when(F.col("created"), "create").when(F.col("joined") > 1, "entity_merge").otherwise("attach"))
    rows = earlier_maximum(rows.drop("strong", "via", "joined").withColumn("time", F.to_timestamp("crawled_at")), "candidate_id", "ord", "time")
    rows = stage(rows.withColumn("out_of_order", F.coalesce(F.col("time") < F.col("earlier"), F.lit(False))).drop("earlier"), "rows")
    seen_fields = observations(rows).join(rows.select("content_hash", "candidate_id"), "content_hash")
    if cache is not None:
        seen_fields = seen_fields.unionByName(_looked_up_fields(cache), allowMissingColumns=True)
    folded = stage(fold(seen_fields, ["candidate_id", "field"], protected=F.col("field").isin(*P.NULL_PROTECTED)), "folded")
    by = ["candidate_id", "field"]
    log = changes(folded, by).join(rows.select("candidate_id", F.col("ord"), "created", "batch"), ["candidate_id", "ord"], "left")
    log = log.where(~F.coalesce("created", F.lit(False))).withColumn("batch", F.coalesce("batch", F.lit(P.ENRICHMENT)))
    log = log.select("candidate_id", "field", "ord", "batch", "rule", "applied", F.col("old.value").alias("old_value"), F.col("new.value").alias("new_value"), F.col("new.source").alias("source"))
    skill_log, skill_sets = _skills(rows)
    log = stage(log.unionByName(skill_log, allowMissingColumns=True), "changes")
    declined = stage(_declined(namesakes_of(rows) if namesakes is None else namesakes_of(rows).unionByName(namesakes)), "declined")
    candidates = stage(_candidates(rows, folded, identities, skill_sets, declined), "candidates")
    return People(rec, rows, candidates, identities, history(folded, by), log, conflicts(folded, by), declined, merged, folded)


def _looked_up(cache: DataFrame) -> DataFrame:
    """The found responses with an order: behind every row of the batch they followed (``~`` sorts after digits)."""
    time = F.date_format("fetched_at", "'~'yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    order = F.struct(F.col("after_batch").cast("int").alias("batch_seq"), time.alias("crawled_at"), F.lit(0).alias("source_row_id"), F.col("lookup_key").alias("content_hash"))
    confidence = F.coalesce("confidence", F.lit(P.CONFIDENCE[P.ENRICHMENT]))
    return cache.where("status = 'found'").withColumns({"ord": order, "source": F.lit(P.ENRICHMENT), "confidence": confidence})


def _looked_up_fields(cache: DataFrame) -> DataFrame:
    pair = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("field"), F.col(c).alias("value"), F.col(c).alias("eq")))
    each = _looked_up(cache).select("candidate_id", "ord", "source", F.col("fetched_at").alias("time"), "confidence", F.explode(F.array_compact(F.array(pair("current_title"), pair("current_company")))).alias("f"))
    return each.select("candidate_id", "ord", "source", "time", "confidence", "f.*").withColumn("rank", trust_rank(F.col("field"), F.col("source")))


def _looked_up_identifiers(cache: DataFrame, owned: DataFrame, owners: DataFrame | None = None) -> DataFrame:
    """Identifiers of responses, less those that another candidate owns."""
    found = _looked_up(cache).select("candidate_id", "ord", "source", "confidence", F.explode(F.array_compact(F.array(_mail(F.col("work_email")), _mail(F.col("personal_email")), _phone(F.col("mobile"))))).alias("i"))
    found = found.select("candidate_id", "ord", "source", "confidence", "i.*")
    owned = owned.select("itype", "match_key", "candidate_id", "ord")
    owner = (owned if owners is None else owned.unionByName(owners)).groupBy("itype", "match_key").agg(F.min_by("candidate_id", "ord").alias("owner"))
    return found.join(owner, ["itype", "match_key"], "left").where(F.coalesce(F.col("owner") == F.col("candidate_id"), F.lit(True))).drop("owner")


def look_up_plan(p: People, cache: DataFrame | None) -> DataFrame:
    """candidate_id, lookup_key, completeness_score, state of every candidate without mail and phone.

    States: ``no_key`` (no handle to look up), ``cached`` (paid for before), ``selected`` (the best that the rest of the
    budget pays for) and ``over_budget``.
    """
    handle = p.identities.where("itype = 'linkedin_handle' AND is_canonical").select("candidate_id", F.col("match_key").alias("lookup_key"))
    lost = p.candidates.where(~F.col("contactable")).select("candidate_id", "completeness_score")
    no_key = lost.join(handle, "candidate_id", "left_anti").select("candidate_id", F.lit(None).cast("string").alias("lookup_key"), "completeness_score", F.lit("no_key").alias("state"))
    wanted, spent, out = lost.join(handle, "candidate_id"), 0, no_key
    if cache is not None:
        wanted, cached = enrich.split_cache(wanted, cache, "lookup_key")
        spent = cache.count()
        out = out.unionByName(cached.withColumn("state", F.lit("cached")))
    wanted = stage(wanted, "wanted")
    chosen = enrich.best_within(wanted, spent, "candidate_id", "completeness_score").select("candidate_id", F.lit(True).alias("selected"))
    state = F.when(F.col("selected"), "selected").otherwise("over_budget")
    return stage(out.unionByName(wanted.join(chosen, "candidate_id", "left").withColumn("state", state).drop("selected")), "look-up-plan")


def look_up(p: People, provider: DataFrame, cache: DataFrame | None, now, after_batch: int) -> DataFrame:
    """New rows of the cache: candidates without mail and phone but with a handle, the best first, as far as the budget goes."""
    chosen = look_up_plan(p, cache).where("state = 'selected'").drop("state")
    return enrich.bill(chosen, provider, "lookup_key", now).withColumn("after_batch", F.lit(after_batch))


def look_up_report(before: People, after: People, plan: DataFrame, cache: DataFrame | None, billed: DataFrame) -> DataFrame:
    """One row: rows_in, what the run spent, served from the cache and saved, and who could be contacted before and after.

    ``plan`` and ``cache`` are those before the run, ``billed`` what ``look_up`` returned. The lists of candidates that were
    skipped and selected are the plan's rows by state.
    """
    paid = billed.agg(F.count("*").alias("calls_made"), F.coalesce(F.sum("cost"), F.lit(0)).cast("double").alias("spend_inr"))
    served = plan.where("state = 'cached'")
    served = served.withColumn("miss", F.lit(False)) if cache is None else served.join(cache.groupBy("lookup_key").agg(F.bool_or(F.col("status") == "not_found").alias("miss")), "lookup_key")
    hits = served.agg(F.count("*").alias("calls_served_from_cache"), F.count_if("miss").alias("negative_cache_hits"), F.round(F.count("*") * P.LOOKUP_COST, 2).alias("saved_inr"))
    reach = lambda x, name: x.candidates.agg(F.count_if("contactable").alias(name))
    out = plan.agg(F.count("*").alias("rows_in"), F.lit(P.LOOKUP_BUDGET).alias("budget_calls"))
    for part in (paid, hits, reach(before, "contactable_before"), reach(after, "contactable_after")):
        out = out.withColumn("_one", F.lit(1)).join(part.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return out


def _identities(rows: DataFrame, cache: DataFrame | None = None, owners: DataFrame | None = None) -> DataFrame:
    """One row for each (candidate, type, key); canonical: work mail first, then the most confident, then the first seen."""
    confidence = F.create_map(*[F.lit(x) for pair in P.CONFIDENCE.items() for x in pair])
    i = rows.select("candidate_id", "ord", "source", F.explode("identifiers").alias("i")).select("candidate_id", "ord", "source", confidence[F.col("source")].alias("confidence"), "i.*")
    if cache is not None:
        i = i.unionByName(_looked_up_identifiers(cache, i, owners))
    one = i.groupBy("candidate_id", "itype", "match_key").agg(
        F.min_by("value", "ord").alias("value"), F.min_by("email_type", "ord").alias("email_type"), F.array_sort(F.collect_set("raw_form")).alias("raw_forms"), F.array_sort(F.collect_set("source")).alias("observed_in"),
        F.max("confidence").alias("confidence"), F.min("ord").alias("first_ord"), F.max_by("source", "ord").alias("latest_source"),
    )
    best = Window.partitionBy("candidate_id", "itype").orderBy(F.when(F.col("email_type") == "work", 0).otherwise(1), F.col("confidence").desc(), "first_ord", "match_key")
    return stage(one.withColumn("is_canonical", F.row_number().over(best) == 1), "identities")


def _skills(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The change log's rows for skills that a later row adds, and each candidate's set."""
    each = rows.select("candidate_id", "ord", "batch", "source", "created", F.explode("skills").alias("skill"))
    new = each.groupBy("candidate_id", "skill").agg(F.min_by(F.struct("ord", "batch", "source", "created"), "ord").alias("r")).select("candidate_id", "skill", "r.*")
    log = new.where(~F.col("created")).groupBy("candidate_id", "ord", "batch", "source").agg(F.to_json(F.array_sort(F.collect_list("skill"))).alias("new_value"))
    log = log.withColumns({"field": F.lit("skills"), "rule": F.lit("skills_union"), "applied": F.lit(True), "old_value": F.lit(None).cast("string")})
    return log, each.groupBy("candidate_id").agg(F.array_sort(F.collect_set("skill")).alias("skills"))


def namesakes_of(rows: DataFrame) -> DataFrame:
    """candidate_id, ord, source_row_id, batch, name of the rows that created an entity and have a name."""
    name = F.lower(F.filter("fields", lambda f: f["field"] == "full_name")[0]["value"])
    return rows.where("created").select("candidate_id", "ord", "source_row_id", "batch", F.when(F.exists("fields", lambda f: f["field"] == "full_name"), name).alias("name")).where("name IS NOT NULL")


def _declined(created: DataFrame) -> DataFrame:
    """Pairs of rows whose entities share a name and nothing stronger: the later entity's first row and the name's first row."""
    first = created.groupBy("name").agg(F.min_by(F.struct("candidate_id", "source_row_id"), "ord").alias("f"))
    return created.join(first, "name").where("candidate_id <> f.candidate_id").select("name", "batch", "candidate_id", F.col("f.candidate_id").alias("other_id"), F.array_sort(F.array("f.source_row_id", "source_row_id")).alias("rows"))


def _candidates(rows: DataFrame, folded: DataFrame, identities: DataFrame, skills: DataFrame, declined: DataFrame) -> DataFrame:
    value = lambda f: F.max(F.when(F.col("field") == f, F.col("current.value"))).alias(f)
    wide = current(folded, ["candidate_id", "field"]).groupBy("candidate_id").agg(*[value(f) for f in P.FIELDS])
    base = rows.groupBy("candidate_id").agg(F.min("created_ord").alias("created_ord"), F.min("time").alias("first_seen_at"), F.max("time").alias("last_seen_at"), F.countDistinct("source").alias("source_count"), F.bool_or("combined").alias("_c"))
    ident = identities.groupBy("candidate_id").agg(
        F.count("*").alias("identity_count"), F.bool_or(F.col("itype").isin("email", "phone")).alias("contactable"), F.max(F.when((F.col("itype") == "email") & F.col("is_canonical"), F.col("value"))).alias("primary_email"),
        F.max(F.when((F.col("itype") == "phone") & F.col("is_canonical"), F.col("value"))).alias("primary_phone"), F.bool_or(F.col("itype") == "email").alias("_mail"), F.bool_or(F.col("itype") == "phone").alias("_phone"),
    )
    collided = declined.select("candidate_id").union(declined.select("other_id")).distinct().withColumn("_n", F.lit(True))
    out = base.join(wide, "candidate_id", "left").join(ident, "candidate_id", "left").join(skills, "candidate_id", "left").join(collided, "candidate_id", "left")
    flags = F.array_sort(F.array_compact(F.array(F.when(F.col("_c"), "combination_match_applied"), F.when(F.col("_n"), "name_collision_reviewed"))))
    out = out.select(
        "candidate_id", "created_ord", "full_name", F.lower("full_name").alias("normalized_name"), "current_title", "current_company", *[F.get_json_object("location", f"$.{x}").alias(n) for x, n in (("raw", "location_raw"), ("city", "city"), ("state", "state"))], F.get_json_object("location", "$.country").alias("country"), F.col("experience_months").cast("int"),
        F.col("annual_salary_inr").cast("long"), F.col("notice_period_days").cast("int"), F.coalesce("skills", F.array().cast("array<string>")).alias("skills"), F.col("open_to_work").cast("boolean"), "primary_email", "primary_phone", "contactable",
        "source_count", "identity_count", "first_seen_at", "last_seen_at", flags.alias("data_quality_flags"), "_mail", "_phone",
    )
    # Eleven signals; zero and empty count as unfilled.
    filled = lambda c: F.when(c, 1).otherwise(0)
    eleven = [filled(F.col(c).isNotNull() & (F.col(c) != "")) for c in ("full_name", "current_title", "current_company", "city")] + [filled(F.col(c) > 0) for c in ("experience_months", "annual_salary_inr", "notice_period_days")]
    eleven += [filled(F.size("skills") > 0), filled(F.col("open_to_work").isNotNull()), filled(F.col("_mail")), filled(F.col("_phone"))]
    return out.withColumn("completeness_score", F.round(sum(eleven, F.lit(0)) / 11.0, 3).cast("decimal(4,3)")).drop("_mail", "_phone")


def report(p: People, batch: str) -> DataFrame:
    """One row: the counters of a batch."""
    mine = F.col("batch") == batch
    rows, log = p.rows.where(mine), p.change_log.where(mine)
    created = rows.where("created").agg(F.count("*").alias("entities_created"))
    touched = rows.groupBy("candidate_id").agg(F.bool_or("created").alias("created"))
    changed = log.where("applied").groupBy("candidate_id").count()
    split = touched.join(changed, "candidate_id", "left").agg(F.count_if(~F.col("created") & (F.col("count") > 0)).alias("entities_updated"), F.count_if(~F.col("created") & F.col("count").isNull()).alias("entities_unchanged_noop"))
    all_rows = p.records.where(mine).agg(F.count("*").alias("rows_in"), F.count("reason").alias("rows_rejected"))
    until = rows.agg(F.max("ord.batch_seq").alias("_until"))
    rows_of = p.rows.join(F.broadcast(until), F.col("ord.batch_seq") <= F.col("_until")).join(touched.select("candidate_id"), "candidate_id", "left_semi").groupBy("candidate_id").agg(F.count("*").alias("n"))
    merged = rows_of.agg(F.count_if(F.col("n") > 1).alias("merge_groups"))
    met = fights(p, batch).agg(F.count("*").alias("conflicts_resolved"))
    counts = log.agg(F.count_if("applied").alias("fields_changed"), F.count_if(F.col("rule").startswith("REJECTED")).alias("nulls_ignored"))
    late = rows.agg(F.count_if("out_of_order").alias("out_of_order_records"))
    declined = p.declined.where(mine).agg(F.count("*").alias("merges_declined"))
    one = F.lit(1).alias("_one")
    out = all_rows.withColumn("_one", one)
    for part in (created, split, merged, declined, counts, met, late):
        out = out.join(part.withColumn("_one", one), "_one")
    return out.select(F.lit(batch).alias("batch"), *[c for c in out.columns if c != "_one"])


def merges(p: People, batch: str) -> DataFrame:
    """candidate_id, rule, rows of every candidate that the batch touched and several rows up to it make up."""
    mine = p.rows.where(F.col("batch") == batch)
    until = mine.agg(F.max("ord.batch_seq").alias("_until"))
    rule = mine.groupBy("candidate_id").agg(F.coalesce(F.min_by("rule", F.when(F.col("rule").isNotNull(), F.col("ord"))), F.lit("identifier_exact")).alias("rule"))
    upto = p.rows.select("candidate_id", "ord").join(F.broadcast(until), F.col("ord.batch_seq") <= F.col("_until")).join(rule, "candidate_id")
    return upto.groupBy("candidate_id", "rule").agg(F.sort_array(F.collect_list("ord.source_row_id")).alias("rows")).where(F.size("rows") > 1)


def declines(p: People, batch: str) -> DataFrame:
    """rows, reason, detail of every pair of candidates that share a name and nothing stronger."""
    return p.declined.where(F.col("batch") == batch).select("rows", F.lit("name_match_only_insufficient").alias("reason"), F.lit("same normalized_name, different strong identifiers").alias("detail"))


def fights(p: People, batch: str) -> DataFrame:
    """field, winner, loser, rule of every conflict that the batch's rows met."""
    mine = p.rows.where(F.col("batch") == batch).select("candidate_id", "ord")
    return p.conflicts.join(mine, ["candidate_id", "ord"], "left_semi").select("field", "winner", "loser", "rule")


def report_row(p: People, batch: str, started_at, finished_at, enrichment: DataFrame | None = None) -> DataFrame:
    """One row of the report table: run_id, batch, started_at, finished_at and the report with its sixteen keys.

    The report's lists are one row: for batches whose merges, refusals and conflicts fit into one. ``merges``, ``declines``
    and ``fights`` give them as tables at any size. ``enrichment`` is the row of ``look_up_report``, if there was such a run.
    """
    one = F.lit(1).alias("_one")
    gather = lambda df, name: df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name)).select("*", one)
    reasons = p.records.where((F.col("batch") == batch) & F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("n"))
    reasons = reasons.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias("rejection_reasons")).select("*", one)
    out = report(p, batch).drop("merges_declined", "conflicts_resolved").select("*", one)
    for part in (reasons, gather(merges(p, batch), "merges"), gather(declines(p, batch), "merges_declined"), gather(fights(p, batch), "conflicts_resolved")):
        out = out.join(part, "_one")
    if enrichment is None:
        out = out.withColumn("enrichment", F.struct(F.lit(P.LOOKUP_BUDGET).alias("budget_calls")))
    else:
        out = out.join(enrichment.select(F.struct(*enrichment.columns).alias("enrichment"), one), "_one")
    keys = (
        "batch", "started_at", "duration_ms", "rows_in", "rows_rejected", "rejection_reasons", "entities_created", "entities_updated", "entities_unchanged_noop", "merges", "merges_declined", "fields_changed",
        "conflicts_resolved", "out_of_order_records", "nulls_ignored", "enrichment",
    )
    out = out.withColumns({"started_at": started_at, "finished_at": finished_at, "duration_ms": F.unix_millis(finished_at) - F.unix_millis(started_at)})
    return out.select(N.deterministic_id("run_", F.col("batch"), F.col("started_at")).alias("run_id"), "batch", "started_at", "finished_at", F.struct(*keys).alias("report"))


def write_report(row: DataFrame, path: str) -> None:
    """The report as one JSON object a line, into a folder named after the batch (without underscores)."""
    name = row.first()["batch"].replace("_", "")
    row.select(F.to_json("report", {"ignoreNullFields": "false"})).write.mode("overwrite").text(f"{path.rstrip('/')}/run_report_{name}.json")


def append_report(row: DataFrame, path: str) -> None:
    """Append to the table of reports, which ``search.latest_report`` reads."""
    row.withColumn("report", F.to_json("report", {"ignoreNullFields": "false"})).write.mode("append").parquet(path)


EXPORT_COLUMNS = (
    "candidate_id", "full_name", "current_title", "current_company", "city", "country", "experience_months", "annual_salary_inr", "notice_period_days", "skills", "open_to_work", "primary_email", "primary_phone", "contactable",
    "completeness_score", "source_count", "identity_count", "first_seen_at", "last_seen_at", "enriched", "enrichment_cost_inr", "data_quality_flags",
)


def export_rows(candidates: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """The 22 columns as text, in the order of creation; ``cache``: what ``look_up`` returned and ``build`` has merged."""
    c = candidates
    if cache is not None:
        paid = cache.groupBy("candidate_id").agg(F.bool_or(F.col("status") == "found").alias("enriched"), F.sum("cost").alias("enrichment_cost_inr"))
        c = c.join(paid, "candidate_id", "left")
    else:
        c = c.withColumns({"enriched": F.lit(False), "enrichment_cost_inr": F.lit(0)})
    yes = lambda x: F.when(F.coalesce(F.col(x), F.lit(False)), "true").otherwise("false")
    time = lambda x: F.date_format(x, "yyyy-MM-dd'T'HH:mm:ssxxx")
    shape = {"skills": F.array_join("skills", ";"), "data_quality_flags": F.array_join("data_quality_flags", ";"), "open_to_work": yes("open_to_work"), "contactable": yes("contactable"), "enriched": yes("enriched")}
    shape |= {"completeness_score": N.fixed(F.col("completeness_score").cast("double"), 3), "enrichment_cost_inr": N.fixed(F.coalesce(F.col("enrichment_cost_inr").cast("double"), F.lit(0.0)), 2)}
    shape |= {"first_seen_at": time("first_seen_at"), "last_seen_at": time("last_seen_at")}
    return c.orderBy("created_ord").select(*[F.coalesce(shape.get(n, F.col(n).cast("string")), F.lit("")).alias(n) for n in EXPORT_COLUMNS])


def write_csv(rows: DataFrame, path: str, line_end: str = "\n") -> None:
    """CSV parts with a header, in order; an export of entities, written by as many tasks as it has partitions."""
    rows.write.mode("overwrite").option("header", True).option("emptyValue", "").option("lineSep", line_end).csv(path)


def write_csv_file(rows: DataFrame, order: list[str], path: str, line_end: str = "\n") -> None:
    """One CSV file with one header, in order, written by as many tasks as there are ranges.

    The parts are ranges of the order, written without a header; they are then joined byte by byte through the Hadoop file
    system, the header first, and the finished file takes its name in one step. The driver copies streams and holds no rows.
    """
    spark = rows.sparkSession
    parts = f"{shared_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    columns = [c for c in rows.columns if c not in order]
    shaped = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)
    shaped.write.option("emptyValue", "").option("lineSep", line_end).csv(parts)
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new = jvm.org.apache.hadoop.fs.Path
    source, target, draft = new(parts), new(path), new(f"{path}._draft-{uuid.uuid4().hex}")
    fs, to = source.getFileSystem(conf), target.getFileSystem(conf)
    out = to.create(draft, True)
    try:
        out.write(bytearray((",".join(columns) + line_end).encode()))
        for name in sorted(x.getPath().getName() for x in fs.listStatus(source) if x.getPath().getName().startswith("part-")):
            part = fs.open(new(f"{parts}/{name}"))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
            part.close()
    finally:
        out.close()
    to.delete(target, False)
    to.rename(draft, target)
    fs.delete(source, True)


def valid_times(provenance: DataFrame) -> DataFrame:
    """candidate_id, field, value, source, rule, valid_from, valid_to: which value of a field was current over which part of the order.

    ``valid_from`` is the order of the row that set the value, ``valid_to`` that of the row that replaced it (excluded; null: still current).
    """
    seen = provenance.select("candidate_id", "field", "version", F.col("observation.value").alias("value"), F.col("observation.source").alias("source"), F.col("observation.time").alias("observed_at"), "rule", F.col("observation.ord").alias("valid_from"))
    after = seen.select("candidate_id", "field", (F.col("version") - 1).alias("version"), F.col("valid_from").alias("valid_to"))
    return seen.join(after, ["candidate_id", "field", "version"], "left")


def values_at(valid: DataFrame, moments: DataFrame) -> DataFrame:
    """candidate_id, at, field, value, source, observed_at: what was current just after the row of order ``at``, for each moment (candidate_id, at).

    Moments and the intervals' starts of a field are sorted together and each moment takes the last start before it, so that
    a candidate of very many moments and intervals costs their sum and not their product. Starts of one order go by version.
    """
    starts = valid.select("candidate_id", "field", F.col("valid_from").alias("at"), F.lit(0).alias("asked"), "version", F.struct("value", "source", "observed_at").alias("held"))
    asked = moments.select("candidate_id", "at").distinct().join(valid.select("candidate_id", "field").distinct(), "candidate_id")
    both = starts.unionByName(asked.withColumn("asked", F.lit(1)), allowMissingColumns=True)
    before = Window.partitionBy("candidate_id", "field").orderBy("at", "asked", "version").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("held", F.last("held", ignorenulls=True).over(before)).where("asked = 1 AND held IS NOT NULL").select("candidate_id", "at", "field", "held.*")


def attributions(p: People, candidate_id: str) -> DataFrame:
    """Why a record says what it says: the current value of each field with its source, row and rule."""
    now = p.provenance.where((F.col("candidate_id") == candidate_id) & F.col("is_current"))
    o = F.col("observation")
    return now.select("field", o["value"].alias("value"), o["source"].alias("source"), o["ord"]["source_row_id"].alias("source_row"), o["time"].alias("observed_at"), o["confidence"].alias("confidence"), "rule").orderBy("field")


def change_history(p: People, candidate_id: str) -> DataFrame:
    """What changed in a record, newest first; refused changes, which were never applied, last."""
    mine = p.change_log.where(F.col("candidate_id") == candidate_id)
    applied = F.when(F.col("applied"), F.try_to_timestamp(F.regexp_replace("ord.crawled_at", "^~", "")))
    return mine.select("field", "old_value", "new_value", "source", F.col("ord.source_row_id").alias("source_row"), "batch", "rule", applied.alias("applied_at")).orderBy(F.col("applied_at").desc_nulls_last(), "field", "source_row")
