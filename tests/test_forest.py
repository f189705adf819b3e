"""Components, spanning forests and merge histories against ordered union-finds, in rounds and in one task."""

import random

import pytest

from kinfold.operators.components import connected_components
from kinfold.operators.forest import links, merge_history, spanning_forest
from kinfold.plans import catalogue


def _union_find(rows):
    """Rows in order as (node, time, keys): (joined by node, merges, entities) as the rules have it, one row after the other."""
    owner, entities, joined, merges, member = {}, {}, {}, [], {}
    for place, (node, time, keys) in enumerate(rows):
        found = sorted({owner[k] for k in keys if k in owner}, key=lambda e: (entities[e][0], entities[e][1]))
        joined[node] = len(found)
        if not found:
            entities[node] = [time, place]
            found = [node]
        first = found[0]
        for loser in found[1:]:
            merges.append((first, loser, place, node))
            entities[first][0] = min(entities[first][0], entities.pop(loser)[0])
            owner = {k: first if e == loser else e for k, e in owner.items()}
            member = {n: first if e == loser else e for n, e in member.items()}
        entities[first][0] = min(entities[first][0], time)
        member[node] = first
        owner |= {k: first for k in keys}
    return joined, sorted(merges), member


@pytest.mark.parametrize("seed, local", [(0, 20_000), (1, 0), (2, 4)])
def test_merges_of_random_streams(spark, seed, local):
    r = random.Random(seed)
    rows = [(f"n{i:03d}", r.randrange(60), [f"k{r.randrange(70)}" for _ in range(r.choice([1, 1, 2, 3]))] + ["hot"] * (r.random() < 0.05)) for i in range(130)]
    r.shuffle(rows)
    table = spark.createDataFrame([(n, i, t) for i, (n, t, _) in enumerate(rows)], "node string, ord int, time int").selectExpr("node", "ord", "timestamp_seconds(time) AS time")
    holders = spark.createDataFrame([(n, k) for n, _, keys in rows for k in keys], "node string, key string")
    edges = links(table, holders)
    parts = connected_components(edges, local=local)
    table = table.join(parts, "node", "left").selectExpr("node", "ord", "time", "coalesce(component, node) AS entity")
    outcomes, merges, final = merge_history(table, edges, local=local)
    joined, want, member = _union_find(rows)
    assert {x.node: x.joined for x in outcomes.collect()} == joined
    assert sorted((x.survivor, x.loser, x.ord, x.node) for x in merges.collect()) == want and want
    last = {x.entity: x.survivor for x in final.collect()}
    assert {x.node: last[x.entity] for x in table.collect()} == member


@pytest.mark.parametrize("seed, local", [(s, 20_000) for s in range(6)] + [(6, 0)])
def test_merges_of_rows_with_equal_orders(spark, seed, local):
    """Rows of one order follow one another by node, and each finds what the rows before it have left."""
    r = random.Random(seed)
    rows = sorted((r.randrange(12), i, r.randrange(60), [f"k{r.randrange(50)}" for _ in range(r.choice([1, 2, 3]))]) for i in range(120))
    table = spark.createDataFrame([(i, o, t) for o, i, t, _ in reversed(rows)], "node int, ord int, time int").selectExpr("node", "ord", "timestamp_seconds(time) AS time")
    edges = links(table, spark.createDataFrame([(i, k) for _, i, _, keys in rows for k in keys], "node int, key string"))
    parts = connected_components(edges, local=local)
    table = table.join(parts, "node", "left").selectExpr("node", "ord", "time", "coalesce(component, node) AS entity")
    outcomes, merges, final = merge_history(table, edges, local=local)
    joined, want, member = _union_find([(i, t, keys) for _, i, t, keys in rows])
    order = {i: o for o, i, *_ in rows}
    assert {x.node: x.joined for x in outcomes.collect()} == joined
    assert sorted((x.survivor, x.loser, x.ord, x.node) for x in merges.collect()) == sorted((s, lost, order[i], i) for s, lost, _, i in want) and want
    last = {x.entity: x.survivor for x in final.collect()}
    assert {x.node: last[x.entity] for x in table.collect()} == member


@pytest.mark.parametrize("local", [20_000, 0, 10])
def test_spanning_forest(spark, local):
    r = random.Random(local)
    edges = [(r.randrange(80), r.randrange(80), r.randrange(50)) for _ in range(300)] + [(500, 501, 1), (501, 500, 1), (7, 7, 0)]
    above = {}

    def root(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    want = 0
    for w, a, b in sorted((w, a, b) for a, b, w in edges):
        if root(a) != root(b):
            above[root(b)] = root(a)
            want += w
    df = spark.createDataFrame(edges, "a int, b int, w int")
    got = spanning_forest(df, local=local) if local else _rounds(df)
    got = got.collect()
    assert sum(x.w for x in got) == want and len(got) == len(above) - len({root(x) for x in above})
    assert spanning_forest(df.limit(0)).count() == 0


def _rounds(df):
    """With nothing left to a last task but an empty graph."""
    return spanning_forest(df, local=0)


def test_merge_query(spark, small):
    events = sorted((x.event_id * 7919 % 1000003, x.event_id, x.ts.timestamp(), [f"u{x.user_id}", "k" + x.k]) for x in spark.read.parquet(f"{small}/events.parquet").selectExpr("event_id", "user_id", "CAST(ts AS timestamp) AS ts", "get_json_object(props, '$.k') AS k").collect())
    _, want, _ = _union_find([(e, t, keys) for _, e, t, keys in events])
    order = {i: o for i, (o, *_) in enumerate(events)}
    got = catalogue.queries()["q48_merge_events"](spark, small).collect()
    assert sorted((x.survivor, x.loser, x.ord, x.event_id) for x in got) == sorted((s, lost, order[i], node) for s, lost, i, node in want) and want
