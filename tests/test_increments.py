"""A state that grows by batches against a build of all batches."""

import json
import random

import pytest
from pyspark.sql import functions as F

from kinfold.plans import increments, people
from kinfold.storage import stage


def _batches(seed, n, folder):
    """Rows that share, bridge and lack identifiers, with common names and a few equal quadruples."""
    r = random.Random(seed)
    out, row = [], 0
    for b in range(n):
        lines = []
        for _ in range(r.randint(4, 9)):
            row += 1
            day = f"2024-{r.randint(1, 3):02d}-{r.randint(1, 28):02d}T00:00:00Z"
            name, title, place = r.choice(["Ann Lee", "Bob Roy", "Cy Fox", "Di Oak", "Ed Elm"]), r.choice(["Cook", "Chef"]), r.choice(["Pune", "Surat"])
            handle, mail, phone = (r.randrange(8) for _ in range(3))
            lines.append(r.choice([
                {"_src": "linkedin_scraper", "_row": row, "_crawled_at": day, "profile_url": f"linkedin.com/in/h{handle}", "full_name": name, "current_title": title, "current_company": "Dine", "location": place, "skills": [title], "email": f"m{mail}@corp.org" if r.random() < 0.7 else None},
                {"_src": "naukri_export", "_row": row, "_crawled_at": day, "candidate_name": name, "curr_designation": title, "curr_employer": "Dine Pvt Ltd", "pref_location": place, "mobile": f"98123456{phone:02d}", "key_skills": "sql", "email_id": f"m{mail}@corp.org" if r.random() < 0.7 else ""},
                {"_src": "github_crawl", "_row": row, "_crawled_at": day, "login": f"g{handle}", "name": name, "company": "@dine", "top_languages": ["Go"]},
            ]))
        if b:
            lines.append(json.loads(out[-1][1][0]))  # a replayed row
        out.append((f"b{b}", [json.dumps(x) for x in lines] + ["{broken"] * (b == 1)))
    return [(b, _write(folder / f"{b}.jsonl", lines)) for b, lines in out]


def _write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def _tables(p, batches):
    text = lambda df: sorted(json.dumps(r.asDict(recursive=True), default=str, sort_keys=True) for r in df.collect())
    found = {n: text(getattr(p, n).select(*sorted(getattr(p, n).columns))) for n in ("records", "rows", "candidates", "identities", "change_log", "merged", "declined", "folded")}
    return found | {f"report {b}": text(people.report(p, b)) for b, _ in batches[-1:]}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_equals_a_build(spark, tmp_path, seed):
    batches = _batches(seed, 3, tmp_path)
    whole = _tables(people.build(spark, batches), batches)
    assert whole["merged"] or seed > 1, "the stream should have merges"
    state, at = increments.load(spark, str(tmp_path / "state"), buckets=5), 0
    cut = ([1, 2], [1, 1, 1])[seed - 1]
    for n in cut:
        state = increments.extend(spark, state, batches[at : at + n])
        at += n
    state = increments.load(spark, state.path)
    found = _tables(increments.people(spark, state), batches)
    assert state.version == len(cut) and [t for t in whole if found[t] != whole[t]] == []


def test_untouched_buckets_are_not_read(spark, tmp_path):
    """Files of buckets that a batch doesn't touch stay; an empty batch and a replay write no table; versions stay readable."""
    lines = [json.dumps({"_src": "linkedin_scraper", "_row": i, "_crawled_at": "2024-01-01T00:00:00Z", "profile_url": f"linkedin.com/in/p{i}", "full_name": f"Person N{i}x", "skills": []}) for i in range(60)]
    first = increments.extend(spark, increments.load(spark, str(tmp_path / "s"), buckets=16), [("a", _write(tmp_path / "a", lines))])
    empty = increments.extend(spark, first, [("b", _write(tmp_path / "b", [""])), ("c", str(tmp_path / "a"))])
    assert empty.files == first.files and empty.batches == ["a", "b", "c"]
    one = json.dumps({"_src": "naukri_export", "_row": 99, "_crawled_at": "2024-02-01T00:00:00Z", "linkedin": "linkedin.com/in/p7", "candidate_name": "Person N7x", "mobile": "9812345670"})
    last = increments.extend(spark, empty, [("d", _write(tmp_path / "d", [one]))])
    for table in increments.BY_CANDIDATE:
        changed = {b for b, p in last.files[table].items() if first.files[table].get(b) != p}
        assert len(changed) <= 1, table
    rows = increments.people(spark, last).candidates
    assert rows.count() == 60 and rows.where("primary_phone = '+919812345670'").first().source_count == 2
    assert increments.people(spark, increments.load(spark, last.path, 1)).candidates.where("primary_phone IS NOT NULL").isEmpty()
    keys = increments._keys_of(increments.people(spark, last).rows.where("source_row_id = 99"))
    plan = increments._of(spark, last, "keys", keys)._jdf.queryExecution().executedPlan().toString()
    assert len({b for b, p in last.files["keys"].items() if f"bucket={b}" in plan}) <= 2
    with pytest.raises(Exception, match="exist"):
        increments._save(spark, last)  # another writer's version


def test_look_ups_join_the_state(spark, tmp_path):
    lonely = [json.dumps({"_src": "linkedin_scraper", "_row": i, "_crawled_at": "2024-03-01T00:00:00Z", "profile_url": f"linkedin.com/in/{n}", "full_name": n}) for i, n in enumerate(("cy", "di"))]
    batches = [("b", _write(tmp_path / "l", lonely))]
    state = increments.extend(spark, increments.load(spark, str(tmp_path / "s"), buckets=4), batches)
    p = increments.people(spark, state)
    provider = spark.createDataFrame([("cy", "found", "cy@corp.org", None, None, None, "Cook", 0.9, None)], "lookup_key string, status string, work_email string, personal_email string, mobile string, current_company string, current_title string, confidence double, last_verified string")
    cache = stage(people.look_up(p, provider, None, F.lit("2024-03-02").cast("timestamp"), 0), "cache")
    state = increments.extend(spark, state, [], cache)
    again = increments.extend(spark, state, [], cache)
    assert again.files == state.files
    got, want = increments.people(spark, state).candidates, people.build(spark, batches, cache).candidates
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())) and got.where("contactable").count() == 1
