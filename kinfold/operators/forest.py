"""When entities became one: a minimum spanning forest by processing order, and the merges read from it.

A row is linked to the first row that held each of its identifiers, at the row's own place in the processing order. The
edges of the minimum spanning forest in that order are those that joined something: a row with none of them created an
entity, a row with one was attached to one, and a row with several found several entities that are one person.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kinfold.operators.components import LOCAL_EDGES, connected_components
from kinfold.storage import stage
from kinfold.workers import map_arrow


class _Sets:
    """Disjoint sets with paths halved on the way."""

    def __init__(self):
        self.above: dict = {}

    def root(self, x):
        above = self.above
        while (y := above.setdefault(x, x)) != x:
            above[x] = x = above[y]
        return x

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.above[b] = a
        return a != b


def _lightest(edges: DataFrame) -> DataFrame:
    """u, v, e: of parallel edges the lightest."""
    u, v = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    return edges.where("u <> v").groupBy(u, v).agg(F.min("e").alias("e"))


def _finished(edges: DataFrame) -> DataFrame:
    """e: the forest of a counted, small number of edges, in one task that takes them from the lightest on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets()
        for batch in batches:
            joins = [sets.join(u, v) for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("e").filter(pa.array(joins, pa.bool_()))], names=["e"])

    return map_arrow(edges.select("u", "v", "e").coalesce(1).sortWithinPartitions("e"), run, StructType([edges.schema["e"]]))


def spanning_forest(edges: DataFrame, *, local: int = LOCAL_EDGES) -> DataFrame:
    """a, b, w of the edges of the minimum spanning forest of ``edges`` (the same columns); equal weights are told apart by b and a.

    Boruvka's rounds: every tree takes its lightest edge to another, trees that are joined become one, and of parallel edges the
    lightest stays. A round at least halves the trees. It groups by partial minima only and is written to the shared
    folder. What is left of ``local`` edges is finished by one task.
    """
    now = stage(_lightest(edges.select(F.col("a").alias("u"), F.col("b").alias("v"), F.struct("w", "b", "a").alias("e"))), "forest")
    found = None
    while True:
        if now.count() <= local:
            last = _finished(now)
            found = last if found is None else found.union(last)
            return found.select("e.a", "e.b", "e.w")
        ends = now.select(F.col("u").alias("c"), F.col("v").alias("o"), "e").union(now.select("v", "u", "e"))
        best = stage(ends.groupBy("c").agg(F.min(F.struct("e", "o")).alias("x")).select("c", "x.o", "x.e"), "lightest")
        chosen = stage(best.select("e").distinct(), "chosen")
        found = chosen if found is None else found.union(chosen)
        trees = stage(connected_components(best, "c", "o", local=local), "trees")
        of = lambda c: trees.select(F.col("node").alias(c), F.col("component").alias("_" + c))
        now = stage(_lightest(now.join(of("u"), "u").join(of("v"), "v").select(F.col("_u").alias("u"), F.col("_v").alias("v"), "e")), "forest")


def links(rows: DataFrame, holders: DataFrame) -> DataFrame:
    """a, b, w: b holds an identifier that a was the first to hold; w is b's order.

    ``rows``: node and ord; ``holders``: node and key. An identifier that very many rows hold makes a star, which Spark can split.
    """
    held = stage(holders.select("node", "key").distinct().join(rows.select("node", "ord"), "node"), "held")
    first = stage(held.groupBy("key").agg(F.min(F.struct("ord", "node")).alias("f")), "first")
    return held.join(first, "key").where(F.col("node") != F.col("f.node")).select(F.col("f.node").alias("a"), F.col("node").alias("b"), F.col("ord").alias("w")).distinct()


def merge_history(rows: DataFrame, links: DataFrame, *, local: int = LOCAL_EDGES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node, joined) for every row; (entity, survivor, loser, ord, node) for every merge; (entity, survivor) at the end.

    ``rows``: node, ord, time (of the observation) and entity (the component of all links); ``links``: a, b, w as from
    ``links``, to which others may be added. ``joined`` is how many entities a row found: 0 created one, 2 and more merged them.
    An entity is named by the row that created it. At a merge the entity seen earliest survives, of equal ones the first
    created, and takes over the losers' time.

    Only entities that a row with several links belongs to need the forest. Merges of an entity follow one another, so each such
    entity's rows pass in order through one task, which holds those that later rows are linked to.
    """
    links = stage(links, "links")
    several = links.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").join(rows.select(F.col("node").alias("b"), "entity"), "b")
    mixed = stage(several.select("entity").distinct(), "mixed")
    inside = rows.join(mixed, "entity", "left_semi").select(F.col("node").alias("b"))
    tree = stage(spanning_forest(links.join(inside, "b", "left_semi"), local=local), "tree")
    plain = links.join(inside, "b", "left_anti").select("a", "b", "w")
    joins = tree.union(plain).groupBy("b").agg(F.count("*").alias("joined"), F.sort_array(F.collect_list("a")).alias("parents"))
    outcomes = rows.join(joins, F.col("node") == F.col("b"), "left").select("node", "entity", "ord", "time", F.coalesce("joined", F.lit(0)).cast("int").alias("joined"), "parents")
    outcomes = stage(outcomes, "outcomes")
    merged = outcomes.where("joined > 1").select("entity").distinct()
    anchors = tree.select(F.col("a").alias("node")).distinct().withColumn("anchor", F.lit(True))
    told = outcomes.join(merged, "entity", "left_semi").join(anchors, "node", "left").select("entity", "ord", "node", F.unix_micros(F.col("time").cast("timestamp")).alias("micros"), "parents", "anchor")
    node = told.schema["node"].dataType
    schema = StructType([told.schema["entity"]]).add("survivor", node).add("loser", node).add(told.schema["ord"]).add("node", node)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, out, entity = to_arrow_schema(schema), [], None
        sets, seen, name, created = _Sets(), {}, None, 0

        def last():
            return {"entity": entity, "survivor": name, "loser": None, "ord": None, "node": None}

        for batch in batches:
            for row in batch.to_pylist():
                if row["entity"] != entity:
                    if entity is not None:
                        out.append(last())
                    entity, sets, seen = row["entity"], _Sets(), {}
                # seen: by root the earliest time, the place among the created, and the row that created it.
                roots = {sets.root(p) for p in row["parents"] or ()}
                mine = row["node"]
                if not roots:
                    created += 1
                    seen[mine], roots = (row["micros"], created, mine), {mine}
                first, *losers = sorted(roots, key=lambda r: seen[r][:2])
                for loser in losers:
                    out.append({"entity": entity, "survivor": seen[first][2], "loser": seen[loser][2], "ord": row["ord"], "node": mine})
                    sets.join(first, loser)
                    del seen[loser]
                time, place, name = seen[first]
                seen[first] = (min(time, row["micros"]), place, name)
                if row["anchor"]:
                    sets.join(first, mine)
            if len(out) > 5000:
                yield pa.RecordBatch.from_pylist(out, kind)
                out = []
        if entity is not None:
            out.append(last())
        if out:
            yield pa.RecordBatch.from_pylist(out, kind)

    dealt = told.repartition("entity").sortWithinPartitions("entity", "ord", "node")
    history = stage(map_arrow(dealt, run, schema), "merges")
    first = outcomes.join(merged, "entity", "left_anti").groupBy("entity").agg(F.min_by("node", F.struct("ord", "node")).alias("survivor"))
    final = history.where("loser IS NULL").select("entity", "survivor").union(first)
    return outcomes.select("node", "joined"), history.where("loser IS NOT NULL"), final
