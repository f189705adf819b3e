"""Archive, quarantine, postings, valid time, the single CSV file."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from kinfold.operators.postings import like, pattern_grams, postings
from kinfold.plans import people, quarantine
from kinfold.streaming.archive import Archive, archive_responses


def test_archive(spark, tmp_path):
    name = f"archive_{uuid.uuid4().hex}"
    archive = Archive(spark, name, buckets=4, path=str(tmp_path / "a"))
    rows = spark.createDataFrame([(f"h{i % 50}", i) for i in range(120)] + [(None, 1)], "content_hash string, x int")
    assert archive.append(rows).count() == 50 and archive.append(rows).count() == 0
    new = spark.createDataFrame([("h1", 9), ("n1", 1), ("n1", 2)], "content_hash string, x int")
    fresh = archive.append(new)
    assert [r.content_hash for r in fresh.collect()] == ["n1"] and fresh.count() == 1  # what was returned doesn't change afterwards
    assert archive.table().count() == 51
    # Of the anti join only the new rows are exchanged.
    plan = archive.unseen(new)._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.index("FileScan") if "FileScan" in plan else 0 :]
    assert plan.count("Exchange") == 1 and "Bucketed: true" in stored
    spark.sql(f"DROP TABLE {name}")


def test_response_ids(spark, tmp_path):
    name = f"responses_{uuid.uuid4().hex}"
    archive = Archive(spark, name, buckets=2, path=str(tmp_path / "r"))
    one = spark.createDataFrame([("cy", "found"), ("di", "not_found")], "lookup_key string, status string")
    two = spark.createDataFrame([("found", "cy"), ("found", "ed")], "status string, lookup_key string")
    ids = [{r.lookup_key: r.response_id for r in archive_responses(archive, x).collect()} for x in (one, two)]
    assert ids[0]["cy"] == ids[1]["cy"] and len({*ids[0].values(), *ids[1].values()}) == 3 and archive.table().count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_quarantine(spark, tmp_path):
    owners = spark.createDataFrame([("c1",), ("c2",)], "candidate_id string")
    rows = [("email", "a", "work", "c1", 0.5, 1), ("email", "a", None, "c2", 0.5, 2), ("fax", "b", None, "c1", 0.5, 3), ("phone", "c", "odd", "c9", 2.0, 4), ("phone", None, None, "c1", None, 5), ("phone", None, None, "c1", None, 5), ("phone", "d", None, None, 1.0, 6)]
    df = spark.createDataFrame(rows, "itype string, match_key string, email_type string, candidate_id string, confidence double, first_ord int")
    counts = quarantine.write_checked(df, quarantine.identity_constraints(owners), str(tmp_path / "i"))
    assert counts == {"rows": 7, "kept": 4, "known_type": 1, "known_email_type": 1, "unique_identifier": 1, "owner_exists": 1, "confidence_range": 1}
    assert sorted(str(r.match_key) for r in quarantine.kept(spark, str(tmp_path / "i")).collect()) == ["None", "None", "a", "d"]
    bad = sorted((r.first_ord, r.violation) for r in quarantine.quarantined(spark, str(tmp_path / "i")).collect())
    assert bad == [(2, "unique_identifier"), (3, "known_type"), (4, "confidence_range"), (4, "known_email_type"), (4, "owner_exists")]
    raw = spark.createDataFrame([("h1", "s", 1, 1), ("h2", "s", 1, 2), ("h2", "t", None, 3), ("h4", "t", None, 4)], "content_hash string, source string, source_row_id int, ord int")
    assert quarantine.write_checked(raw, quarantine.raw_constraints(), str(tmp_path / "r")) == {"rows": 4, "kept": 2, "unique_content": 1, "unique_source_row": 1}
    log = spark.createDataFrame([("c1", "f", 1, "r", "s", "x"), ("c1", "f", 1, "r", "s", "y"), ("c7", "f", 2, "r", "s", "z")], "candidate_id string, field string, ord int, rule string, source string, new_value string")
    assert quarantine.write_checked(log, quarantine.change_constraints(owners), str(tmp_path / "c")) == {"rows": 3, "kept": 1, "one_decision": 1, "owner_exists": 1}
    held = spark.createDataFrame([("c1", "f", 0, False), ("c1", "f", 1, True), ("c1", "f", 2, True)], "candidate_id string, field string, version int, is_current boolean").withColumn("current_field", F.expr("IF(is_current, field, NULL)"))
    assert quarantine.write_checked(held, quarantine.provenance_constraints(owners), str(tmp_path / "p")) == {"rows": 3, "kept": 2, "one_current_value": 1, "owner_exists": 0}
    assert quarantine.write_checked(df.limit(0), quarantine.identity_constraints(owners), str(tmp_path / "e"))["rows"] == 0


def test_postings_equal_a_scan(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abAÉ% _x") for _ in range(r.randrange(14)))
    rows = [(i, word() if r.random() < 0.9 else None, word(), [r.choice("ab")]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, name string, firm string, skills array<string>").cache()
    index = postings(df, "id", ["name", "firm"]).cache()
    patterns = [word() for _ in range(8)] + ["", "a", "ab", "aba", "a%a", "aÉ_x", "%", "abaabaabaabaaba", "bab%aba"]
    for p in patterns:
        want = {x.id for x in df.where(F.col("name").ilike(f"%{p}%") | F.col("firm").ilike(f"%{p}%")).collect()}
        assert {x.id for x in like(df, index, "id", ["name", "firm"], p).collect()} == want, p
    role = {x.id for x in df.where(F.col("name").ilike("%aba%") | F.array_contains("skills", "a")).collect()}
    assert {x.id for x in like(df, index, "id", ["name"], "aba", other=F.array_contains("skills", "a")).collect()} == role
    assert pattern_grams("ab%Abc_d\\%ef") == ["abc", "d%e", "%ef"] and pattern_grams("ab") == []


@pytest.mark.parametrize("ranges", [1, 9])
def test_earlier_maximum(spark, ranges):
    """A key with nine tenths of the rows, null keys and values; in ranges that split it."""
    from kinfold.operators.prefix import earlier_maximum

    r = random.Random(ranges)
    rows = [("hot" if r.random() < 0.9 else r.choice(["a", "b", None]), i, r.choice([None, r.randrange(99)])) for i in range(400)]
    df = spark.createDataFrame(r.sample(rows, len(rows)), "k string, o int, v int")
    most, want = {}, {}
    for k, o, v in rows:
        want[o] = most.get(k)
        most[k] = max((x for x in (most.get(k), v) if x is not None), default=None)
    got = earlier_maximum(df, "k", "o", "v", ranges=ranges).collect()
    assert {x.o: x.earlier for x in got} == want and len(got) == len(rows)


def test_one_csv_file(spark, tmp_path):
    rows = spark.createDataFrame([(i * 7 % 500, f'a"{i}', "" if i % 3 else "x,y") for i in range(500)], "created int, name string, note string")
    path = str(tmp_path / "out.csv")
    for end in ("\r\n", "\n"):
        people.write_csv_file(rows.repartition(6), ["created"], path, end)
        rows.orderBy("created").select("name", "note").coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").option("lineSep", end).csv(str(tmp_path / "one"))
        assert open(path, "rb").read() == next((tmp_path / "one").glob("*.csv")).read_bytes()
    people.write_csv_file(rows.limit(0), ["created"], path)
    assert open(path).read() == "name,note\n"


def test_values_at_any_order(spark):
    """Every field at every past order: the same as folding the observations up to it."""
    r = random.Random(8)
    from kinfold.operators.fold import current, fold, history

    rows = [(r.choice("ab"), r.choice("fg"), i, r.choice("xyz"), r.choice(["s", "t"]), f"2024-01-{r.randint(1, 20):02d}", 0.5, r.randrange(2)) for i in range(60)]
    obs = spark.createDataFrame([(c, f, o, v, v, s, t, k, n) for c, f, o, v, s, t, k, n in rows], "candidate_id string, field string, ord int, value string, eq string, source string, time string, confidence double, rank int").withColumn("time", F.col("time").cast("timestamp"))
    by = ["candidate_id", "field"]
    valid = people.valid_times(history(fold(obs, by), by))
    moments = [3, 17, 40, 59]
    got = {(x.candidate_id, x["at"], x.field): (x.value, x.source) for x in people.values_at(valid, spark.createDataFrame([(c, m) for c in "abz" for m in moments], "candidate_id string, at int")).collect()}
    want = {(x.candidate_id, m, x.field): (x.current.value, x.current.source) for m in moments for x in current(fold(obs.where(F.col("ord") <= m), by), by).collect()}
    assert got == want and want


def test_values_at_orders_that_rows_share(spark):
    """An order that sets three values, one after the other: the last of them is current after it, however the intervals arrive."""
    from kinfold.operators.fold import current, fold, history

    rows = [(c, "f", i // 3, "xyz"[i % 3], "xyz"[i % 3], f"s{i}", 0.5, 60 - i) for c in "ab" for i in range(24)]
    obs = spark.createDataFrame(rows, "candidate_id string, field string, ord int, value string, eq string, source string, confidence double, rank int").withColumn("time", F.lit("2024-01-01").cast("timestamp"))
    by = ["candidate_id", "field"]
    valid = people.valid_times(history(fold(obs, by), by)).cache()
    assert valid.where("valid_from = valid_to").count() == 32
    moments = spark.createDataFrame([(c, m) for c in "ab" for m in (0, 4, 7)], "candidate_id string, at int")
    want = {(x.candidate_id, m): (x.current.value, x.current.source) for m in (0, 4, 7) for x in current(fold(obs.where(F.col("ord") <= m), by), by).collect()}
    for order in ("version", F.desc("version")):
        arrived = valid.orderBy(order).coalesce(1)
        got = {(x.candidate_id, x["at"]): (x.value, x.source) for x in people.values_at(arrived, moments).collect()}
        assert got == want
