"""Synthetic crawl batches end to end: matching, fold, refusals, lookups, replay and row order."""

import json

import pytest
from pyspark.sql import functions as F

from kinfold.operators import enrich, postings
from kinfold.operators.components import connected_components
from kinfold.operators.search import SEARCHED, NotFound, detail, latest_report, search, shape
from kinfold.plans import people
from kinfold.sources.crawl import read_provider
from kinfold.storage import stage
from kinfold.streaming.replay import append_new

FIRST = [
    {"_src": "linkedin_scraper", "_row": 1, "_crawled_at": "2024-01-01T00:00:00Z", "profile_url": "linkedin.com/in/ann", "full_name": "Ann Lee", "current_title": "Engineer", "current_company": "Acme Pvt Ltd", "location": "Pune", "skills": ["py"], "email": "ann.lee@gmail.com"},
    {"_src": "naukri_export", "_row": 2, "_crawled_at": "2024-01-02T00:00:00Z", "candidate_name": "LEE, ANN", "curr_designation": "Lead", "total_exp": "6 Years 4 Months", "key_skills": "python, k8s", "email_id": "annlee+x@googlemail.com", "annual_salary": "38 LPA", "notice_period": "Immediate"},
    {"_src": "linkedin_scraper", "_row": 3, "_crawled_at": "2024-01-03T00:00:00Z", "profile_url": "linkedin.com/in/bob", "full_name": "Bob Roy", "current_title": "Chef", "current_company": "Dine", "location": "Surat", "skills": []},
    {"_src": "github_crawl", "_row": 4, "_crawled_at": "2024-01-04T00:00:00Z", "login": "AnnL", "name": "Ann Lee", "top_languages": ["Go"]},
    {"_src": "other", "_row": 5, "_crawled_at": "2024-01-04T00:00:00Z"},
    {"_src": "linkedin_scraper", "_row": 6, "_crawled_at": "2024-01-05T00:00:00Z", "full_name": "Nobody"},
]
SECOND = [
    {"_src": "linkedin_scraper", "_row": 101, "_crawled_at": "2024-02-01T00:00:00Z", "profile_url": "linkedin.com/in/ann", "full_name": "Ann Lee", "current_title": None, "current_company": "Beta", "skills": ["go"]},
    # Same name, company, city and title as row 3 and no identifier in common.
    {"_src": "naukri_export", "_row": 102, "_crawled_at": "2023-12-01T00:00:00Z", "candidate_name": "Bob Roy", "curr_designation": "chef", "curr_employer": "Dine Pvt Ltd", "pref_location": "Surat", "mobile": "9812345670", "key_skills": ""},
]


def _write(path, rows, extra=()):
    path.write_text("\n".join([*map(json.dumps, rows), *extra]) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("crawl")
    batches = [("b1", _write(d / "1.jsonl", FIRST, ["{broken", "", "[1]"])), ("b2", _write(d / "2.jsonl", SECOND))]
    return d, batches, people.build(spark, batches)


def test_reports(built):
    p = built[2]
    one, two = (people.report(p, b).first().asDict() for b in ("b1", "b2"))
    assert (one["rows_in"], one["rows_rejected"], one["entities_created"], one["merge_groups"], one["merges_declined"]) == (8, 4, 3, 1, 1)
    assert (two["rows_in"], two["entities_created"], two["entities_updated"], two["nulls_ignored"], two["out_of_order_records"]) == (2, 0, 1, 1, 1)
    assert {r.reason for r in p.records.where("reason IS NOT NULL").collect()} == {"unparseable_json", "unknown_source", "no_usable_identifier"}


def test_candidates(built):
    rows = {r.primary_email or r.full_name: r for r in people.export_rows(built[2].candidates).collect()}
    ann, bob = rows["ann.lee@gmail.com"], rows["Bob Roy"]
    assert (ann.current_title, ann.current_company, ann.experience_months, ann.annual_salary_inr, ann.skills) == ("Engineer", "Beta", "76", "3800000", "go;kubernetes;python")
    assert (ann.data_quality_flags, bob.data_quality_flags, bob.primary_phone) == ("name_collision_reviewed", "combination_match_applied", "+919812345670")
    log = {(r.field, r.rule) for r in built[2].change_log.collect()}
    assert ("current_title", "REJECTED:null_from_source_is_not_deletion") in log and ("current_company", "newer_observation_same_source") in log
    current = built[2].provenance.where("is_current").groupBy("candidate_id", "field").count()
    assert current.where("count > 1").isEmpty()


def test_replay_and_order_change_nothing(spark, built):
    d, batches, p = built
    again = people.build(spark, [*batches, ("b3", batches[0][1])])
    shuffled = people.build(spark, [("b1", _write(d / "s.jsonl", FIRST[::-1], ["{broken", "[1]"])), batches[1]])
    text = lambda x: sorted(map(tuple, people.export_rows(x.candidates).collect()))
    assert text(again) == text(p) == text(shuffled)
    assert people.report(again, "b1").first() == people.report(p, "b1").first()


def test_lookup_spends_once(spark, built):
    d, batches, _ = built
    (d / "provider.json").write_text(json.dumps({"_meta": {"x": 1}, "cy": {"status": "found", "work_email": "cy@corp.org", "current_title": "Cook", "confidence": 0.9}, "di": {"status": "not_found"}}))
    lonely = [{"_src": "linkedin_scraper", "_row": i, "_crawled_at": "2024-03-01T00:00:00Z", "profile_url": f"linkedin.com/in/{n}", "full_name": n} for i, n in enumerate(("cy", "di", "ed"))]
    batch = [("b", _write(d / "l.jsonl", lonely))]
    p, provider, now = people.build(spark, batch), read_provider(spark, str(d / "provider.json")), F.lit("2024-03-02").cast("timestamp")
    cache = stage(people.look_up(p, provider, None, now, 0), "cache")
    assert cache.count() == 2 and people.look_up(p, provider, cache, now, 0).count() == 0
    plan = people.look_up_plan(p, None)
    assert {r.state for r in plan.collect()} == {"selected"} and {r.state for r in people.look_up_plan(p, cache).collect()} == {"cached", "selected"}
    after = people.build(spark, batch, cache)
    first = people.look_up_report(p, after, plan, None, cache).first().asDict()
    assert first == {"rows_in": 3, "budget_calls": 15, "calls_made": 2, "spend_inr": 0.18, "calls_served_from_cache": 0, "negative_cache_hits": 0, "saved_inr": 0.0, "contactable_before": 0, "contactable_after": 1}
    again = people.look_up_report(after, after, people.look_up_plan(p, cache), cache, people.look_up(p, provider, cache, now, 0)).first().asDict()
    assert (again["calls_made"], again["calls_served_from_cache"], again["negative_cache_hits"], again["saved_inr"], again["spend_inr"]) == (0, 2, 1, 0.18, 0.0)
    rows = {r.full_name: r for r in people.export_rows(after.candidates, cache).collect()}
    assert (rows["Cy"].primary_email, rows["Cy"].current_title, rows["Cy"].enriched, rows["Cy"].enrichment_cost_inr) == ("cy@corp.org", "Cook", "true", "0.09")
    assert (rows["Di"].contactable, rows["Di"].enrichment_cost_inr, rows["Ed"].enrichment_cost_inr) == ("false", "0.09", "0.00")
    assert enrich.expire(cache, F.lit("2024-06-01").cast("timestamp")).count() == 1


def test_look_up_states(spark, tmp_path):
    """Seventeen without mail and phone: one has no handle, the budget pays for fifteen, one is over it."""
    lonely = [{"_src": "linkedin_scraper", "_row": i, "_crawled_at": "2024-03-01T00:00:00Z", "profile_url": f"linkedin.com/in/n{i}", "full_name": f"N{i}", "current_title": "Cook" if i else None} for i in range(16)]
    lonely += [{"_src": "github_crawl", "_row": 20, "_crawled_at": "2024-03-01T00:00:00Z", "login": "zed", "name": "Zed"}, {"_src": "linkedin_scraper", "_row": 21, "_crawled_at": "2024-03-01T00:00:00Z", "profile_url": "linkedin.com/in/m", "full_name": "M", "email": "m@corp.org"}]
    p = people.build(spark, [("b", _write(tmp_path / "l.jsonl", lonely))])
    plan = [(r.state, r.lookup_key) for r in people.look_up_plan(p, None).collect()]
    assert sorted(s for s, _ in plan) == ["no_key", "over_budget"] + ["selected"] * 15
    assert ("no_key", None) in plan and ("over_budget", "n0") in plan  # the one with the least known about it


def test_search(built):
    c = built[2].candidates
    assert search(c, q="beta")[0] == 1 and search(c, role="chef")[0] == 1 and search(c, location="PUNE")[0] == 1
    assert search(c, min_experience=6)[0] == 1 and search(c, open_to_work=False)[0] == 0 and search(c, limit=2, offset=1)[1].count() == 2
    index = stage(postings.postings(c, "candidate_id", list(SEARCHED)), "postings")
    for wanted in ({"q": "beta"}, {"q": "LEE"}, {"role": "chef"}, {"role": "kubernetes"}, {"location": "PUNE"}, {"q": "e", "location": "u%e"}, {"role": "engineer", "q": "ann"}, {"q": "zzz"}):
        one, two = search(c, **wanted), search(c, **wanted, index=index)
        assert one[0] == two[0] and [r.candidate_id for r in one[1].collect()] == [r.candidate_id for r in two[1].collect()], wanted
    with pytest.raises(ValueError):
        search(c, limit=0)
    with pytest.raises(NotFound):
        latest_report(c.sparkSession.createDataFrame([], "run_id string, batch string, started_at timestamp"), "none")


def test_detail(built):
    """One record with identities, provenance by field and the change log, from the built tables."""
    p = built[2]
    ann = next(r.candidate_id for r in p.candidates.collect() if r.primary_email == "ann.lee@gmail.com")
    one = detail(ann, p.candidates, p.identities, p.provenance, p.change_log).first().asDict(recursive=True)
    assert [(i["type"], i["canonical"]) for i in one["identities"]][0] == ("email", True) and one["emails"][0]["value"] == "ann.lee@gmail.com" and one["phones"] == []
    assert one["location"]["city"] == "pune" and one["location"]["raw"] == "Pune" and one["normalized_name"] == "ann lee" and one["completeness_score"] > 0.5
    company = one["field_provenance"]["current_company"]
    assert (company["value"], company["source_row"], [x["reason"] for x in company["superseded"]]) == ("Beta", 101, ["newer_observation_same_source"])
    assert one["field_provenance"]["current_title"]["superseded"] == []
    log = one["change_log"]
    assert log[-1]["applied_at"] is None and log[-1]["rule"].startswith("REJECTED") and all(e["applied_at"] for e in log if not e["rule"].startswith("REJECTED"))
    assert {e["field"] for e in log} >= {"current_company", "current_title", "skills"} and len({e["event_id"] for e in log}) == len(log)
    assert shape(p.candidates).where("skills IS NULL OR data_quality_flags IS NULL").isEmpty()
    with pytest.raises(NotFound):
        detail("nobody", p.candidates, p.identities, p.provenance, p.change_log)


def test_report_sinks(spark, built, tmp_path):
    """Sixteen keys, lists included; the table of reports gives the latest of a batch or of all."""
    p = built[2]
    time = lambda t: F.lit(t).cast("timestamp")
    for batch, at in (("b1", "2024-01-10 10:00:00"), ("b2", "2024-02-10 10:00:00"), ("b1", "2024-01-11 10:00:00")):
        row = stage(people.report_row(p, batch, time(at), time(at) + F.expr("interval 2 seconds")), "report")
        people.append_report(row, str(tmp_path / "reports"))
        people.write_report(row, str(tmp_path))
    reports = spark.read.parquet(str(tmp_path / "reports"))
    assert latest_report(reports).first().batch == "b2" and str(latest_report(reports, "b1").first().started_at) == "2024-01-11 10:00:00"
    with pytest.raises(NotFound):
        latest_report(reports, "b9")
    one = json.loads(spark.read.text(str(tmp_path / "run_report_b1.json")).first().value)
    assert len(one) == 16 and one["duration_ms"] == 2000 and one["rejection_reasons"] == {"no_usable_identifier": 1, "unknown_source": 1, "unparseable_json": 2}
    assert [sorted(m["rows"]) for m in one["merges"]] == [[1, 2]] and one["merges"][0]["rule"] == "email_exact"
    assert one["merges_declined"] == [{"rows": [1, 4], "reason": "name_match_only_insufficient", "detail": "same normalized_name, different strong identifiers"}]
    assert {c["field"] for c in one["conflicts_resolved"]} == {"current_title"} and one["enrichment"] == {"budget_calls": 15}


def test_csv(built, tmp_path):
    people.write_csv(people.export_rows(built[2].candidates).coalesce(1), str(tmp_path / "csv"), "\r\n")
    text = next((tmp_path / "csv").glob("*.csv")).read_bytes().decode()
    assert text.startswith(",".join(people.EXPORT_COLUMNS) + "\r\n") and text.count("\r\n") == 4 and '""' not in text


def test_invariants(built):
    """What the tables hold at most once: a content, an identity's owner, a field's current value; scores and confidences in range."""
    p = built[2]
    several = lambda df, *by: not df.groupBy(*by).count().where("count > 1").isEmpty()
    assert not several(p.rows, "content_hash") and not several(p.identities, "itype", "match_key") and not several(p.candidates, "candidate_id")
    assert not several(p.provenance.where("is_current"), "candidate_id", "field")
    assert p.candidates.where("completeness_score NOT BETWEEN 0 AND 1").isEmpty() and p.identities.where("confidence NOT BETWEEN 0 AND 1").isEmpty()


def test_rank_of_a_common_score(spark):
    """Positions over ranges, most rows having one score."""
    rows = [(i, 0.5 if i % 5 else i / 1000) for i in range(500)]
    got = {r.k: r.position for r in enrich.rank_eligible(spark.createDataFrame(rows, "k long, score double").repartition(5), "k", "score").collect()}
    assert got == {k: n for n, (k, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (None, 3), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_append_new(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("a", 1)], "content_hash string, x int")
    assert sorted(r.content_hash for r in append_new(rows, str(tmp_path / "t")).collect()) == ["a", "b"]
    assert append_new(rows, str(tmp_path / "t")).count() == 0
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
