"""The field fold against a plain loop, and the blocks of the combination rule against all pairs."""

import itertools
import random

from kinfold.operators.fold import changes, conflicts, current, fold, history
from kinfold.operators.resolve import blocks

_ROW = "k long, ord long, value string, eq string, source string, time timestamp, confidence double, rank int"


def _observations(spark, n, keys):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        v = rng.choice([None, "a", "b", "c"])
        # The first key has most of the rows, and one key is null.
        k = rng.choice([0, 0, 0, None, *range(1, keys)])
        rows.append((k, i, v, v, rng.choice("xyz"), rng.randrange(3), rng.choice([None, 0.5, 0.75]), rng.randrange(2)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, ord long, value string, eq string, source string, t long, confidence double, rank int")
    return rows, df.selectExpr("k", "ord", "value", "eq", "source", "timestamp_micros(t) AS time", "confidence", "rank")


def _plain(rows):
    """Key to (current value and order, applied orders, refused orders, conflicting orders)."""
    out = {}
    for k, i, v, _, _, t, c, r in sorted(rows, key=lambda x: x[1]):
        at = out.setdefault(k, [None, [], [], []])
        now = at[0]
        if v is None:
            at[2].extend([i] if now else [])
        elif now is None or v != now[0]:
            at[3].extend([i] if now else [])
            if now is None or (-r, t, c or 0) > now[2]:
                at[0] = (v, i, (-r, t, c or 0))
                at[1].append(i)
    return out


def test_fold_is_a_loop(spark):
    rows, df = _observations(spark, 3000, 40)
    folded, want = fold(df, ["k"]).cache(), _plain(rows)
    assert {r.k: (r.current.value, r.current.ord) for r in current(folded, ["k"]).collect()} == {k: x[0][:2] for k, x in want.items() if x[0]}
    log = changes(folded, ["k"]).collect()
    assert sorted(r.ord for r in log if r.applied) == sorted(i for x in want.values() for i in x[1])
    assert sorted(r.ord for r in log if not r.applied) == sorted(i for x in want.values() for i in x[2])
    assert sorted(r.ord for r in conflicts(folded, ["k"]).collect()) == sorted(i for x in want.values() for i in x[3])
    past = sorted(history(folded, ["k"]).collect(), key=lambda r: (r.k is None, r.k, r.version))
    for k, group in itertools.groupby(past, key=lambda r: r.k):
        group = list(group)
        assert [r.observation.ord for r in group] == want[k][1] and [r.version for r in group] == list(range(len(group)))
        assert [r.superseded_by for r in group] == [r.rule for r in group[1:]] + [None] and [r.is_current for r in group] == [False] * (len(group) - 1) + [True]


def test_fold_of_nothing(spark):
    empty = fold(spark.createDataFrame([], _ROW), ["k"])
    assert empty.count() == 0 and current(empty, ["k"]).count() == 0
    nulls = fold(spark.createDataFrame([(1, 1, None, None, "x", None, None, None)], _ROW), ["k"])
    assert nulls.count() == 0


def test_blocks_are_those_of_all_pairs(spark):
    """Nearly every row has the same name; some rows lack a value."""
    rng = random.Random(5)
    four = lambda: ("ann" if rng.random() < 0.8 else "bob", *(rng.choice([None, *"pqrstu"]) for _ in range(3)))
    rows = [(f"h{i}", f"c{rng.randrange(60):02d}", *four()) for i in range(120)]
    members = spark.createDataFrame([r[:2] for r in rows], "content_hash string, component string")
    signals = spark.createDataFrame([(r[0], *r[2:]) for r in rows], "content_hash string, name string, company string, city string, title string")
    holds = {c: [{r[2 + j] for r in rows if r[1] == c} for j in range(4)] for c in {r[1] for r in rows}}
    label = {c: c for c in holds}
    for r in rows:
        if None not in r[2:]:
            for other in [c for c in holds if c != r[1] and all(r[2 + j] in holds[c][j] for j in range(4))]:
                a, b = label[r[1]], label[other]
                label = {c: min(a, b) if x in (a, b) else x for c, x in label.items()}
    together = lambda of: sorted(sorted(c for c in of if of[c] == x) for x in set(of.values()))
    found = {r.component: r.block for r in blocks(members, signals).collect()}
    assert together(found) == [g for g in together(label) if len(g) > 1]
