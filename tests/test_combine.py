"""The combination rule by fixed point against the rule row by row."""

import json
import random

import pytest
from pyspark.sql import functions as F

from kinfold.operators.combine import FOUR, combine
from kinfold.operators.prefix import earlier
from kinfold.operators.resolve import _fold_block, resolve
from kinfold.plans import people
from kinfold.sources.crawl import read_batches, records

_LONG = "content_hash string, field string, value string, eq string, source string, time timestamp, confidence double, rank int"


def _stream(seed, n, components):
    """Rows in order: components get further rows, values change hands, one name has most of the rows."""
    r = random.Random(seed)
    rows, said = [], []
    for i in range(n):
        h = f"h{i:04d}"
        values = {"name": "ann" if r.random() < 0.8 else "bob", "company": r.choice(["acme", "bolt"]), "city": r.choice(["pune", "goa"]), "title": r.choice(["dev", "cook", "dev"])}
        values = {f: v for f, v in values.items() if r.random() < 0.93}
        if r.random() < 0.05:
            values["title"] = None
        rows.append((h, f"c{min(r.randrange(components), r.randrange(components)):03d}", f"{i:06d}", *[values.get(f) for f in FOUR]))
        for f, v in values.items():
            shown = json.dumps({"city": v}) if f == "city" else v
            said.append((h, f, shown, shown, r.choice("xy"), r.randrange(4), r.choice([0.5, None, 0.9]), r.randrange(2)))
    return rows, said


def _by_rows(rows, said):
    import pandas as pd

    observed = {}
    for h, f, value, eq, source, t, confidence, rank in said:
        key = None if value is None else json.loads(value)["city"] if f == "city" else value
        observed.setdefault(h, []).append({"field": f, "value": value, "eq": eq, "source": source, "key": key, "time": t, "confidence": confidence, "rank": rank})
    table = pd.DataFrame([(*row, observed.get(row[0])) for row in rows], columns=["content_hash", "component", "position", *FOUR, "observed"]).astype(object)
    table = table.sample(frac=1, random_state=1)
    found = _fold_block(table.where(table.notna(), None))
    return sorted(map(tuple, found.astype(object).where(found.notna(), None).values.tolist()))


def _frames(spark, rows, said):
    table = spark.createDataFrame(rows, "content_hash string, component string, position string, " + ", ".join(f"{f} string" for f in FOUR))
    observed = spark.createDataFrame(said, _LONG.replace("time timestamp", "t long")).withColumn("time", F.timestamp_micros("t")).drop("t")
    return table, observed


@pytest.mark.parametrize("seed, n, components, ranges", [(0, 60, 25, None), (1, 90, 70, 3)])
def test_fixed_point_is_row_by_row(spark, seed, n, components, ranges):
    rows, said = _stream(seed, n, components)
    got = combine(*_frames(spark, rows, said), ranges=ranges).collect()
    want = _by_rows(rows, said)
    assert sorted((x.content_hash, x.entity, x.combined, x.via) for x in got) == want
    assert any(x[2] for x in want)


def test_joins_that_depend_on_joins(spark):
    """Each row takes the entity on to new values, which the next row's component is told by."""
    rows, said = [], []
    for i in range(8):
        title = f"t{(i + 1) // 2}"
        rows.append((f"h{i:04d}", f"c{i // 2 * 2 + (i % 2):03d}" if i % 2 == 0 else "c000", f"{i:06d}", "ann", "acme", "pune", title))
        for f, v in zip(FOUR, ("ann", "acme", json.dumps({"city": "pune"}), title)):
            said.append((rows[-1][0], f, v, v, "x", i, 0.5, 1))
    want = _by_rows(rows, said)
    assert sum(x[2] for x in want) == 3 and len({x[1] for x in want}) == 1
    assert sorted(map(tuple, combine(*_frames(spark, rows, said)).collect())) == want


def test_no_rows(spark):
    empty = [spark.createDataFrame([], s) for s in ("content_hash string, component string, position string, " + ", ".join(f"{f} string" for f in FOUR), _LONG)]
    assert combine(*empty).count() == 0


@pytest.mark.parametrize("ranges", [None, 7])
def test_earlier(spark, ranges):
    r = random.Random(4)
    rows = [(r.choice(["hot", "hot", "hot", "a", None]), i, r.choice([None, r.randrange(50)])) for i in range(400)]
    r.shuffle(rows)
    got = earlier(spark.createDataFrame(rows, "k string, o int, v long"), "k", "o", {"most": ("max", "v"), "total": ("sum", "v"), "odd": ("bit_xor", "v")}, ranges=ranges).collect()
    assert len(got) == len(rows)
    for x in got:
        before = [v for k, o, v in rows if k == x.k and o < x.o and v is not None]
        odd = 0
        for v in before:
            odd ^= v
        assert (x.most, x.total, x.odd) == ((max(before), sum(before), odd) if before else (None, None, None))


def _batch(path, rows):
    path.write_text("\n".join(json.dumps(x) for x in rows) + "\n")
    return str(path)


def test_resolution_is_the_same_by_rows_and_by_fixed_point(spark, tmp_path):
    r = random.Random(9)
    naukri = lambda i: {"_src": "naukri_export", "_row": i, "_crawled_at": f"2026-01-{1 + i % 28:02d}T00:00:00Z", "candidate_name": r.choice(["Ann Lee", "Ann Lee", "Bob Ray"]), "curr_employer": r.choice(["Acme", "Bolt"]), "pref_location": "Pune", "curr_designation": r.choice(["Dev", "Cook"]), "email_id": f"p{r.randrange(40)}@x.com"}
    # Rows that say nothing but who they are have an entity as well.
    bare = [{"_src": "github_crawl", "_row": 900 + i, "_crawled_at": "2026-02-01T00:00:00Z", "login": f"coder{i}"} for i in range(3)]
    lines = read_batches(spark, [("b1", _batch(tmp_path / "b1.jsonl", [naukri(i) for i in range(60)] + bare))])
    accepted = records(lines).where("reason IS NULL").cache()
    rows = lambda df: sorted((x.content_hash, x.entity, x.combined, x.via) for x in df.collect())
    want = rows(resolve(accepted))
    assert len(want) == accepted.count() and any(x[2] for x in want)
    assert rows(resolve(accepted, local=0)) == want
    assert rows(resolve(accepted, local=0, block_rows=0)) == want
    built = people.build(spark, [("b1", str(tmp_path / "b1.jsonl"))])
    assert built.candidates.count() == len({x[1] for x in want})
