"""Components of all events against a union-find."""

from kinfold.plans import catalogue


def test_components_of_all_events(spark, tmp_path):
    """Every event links its user and key, whatever its type and value; one component holds most."""
    pairs = [(u, 0) for u in range(40)] + [(3, 1), (50, 2), (51, 2), (51, 3), (60, 9)]
    rows = [(i, u, "view" if i % 2 else "purchase", float(i % 7), f'{{"k": {k}}}') for i, (u, k) in enumerate(pairs)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    label = {}
    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x
    for u, k in pairs:
        a, b = sorted((root(f"u{u:012d}"), root(f"k{k}")))
        label[b] = a
    found = catalogue.queries()["q47_components_all"](spark, str(tmp_path)).collect()
    assert sorted((r.node, r.component) for r in found) == sorted((x, root(x)) for x in label)
