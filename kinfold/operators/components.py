"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.storage import stage
from kinfold.workers import map_arrow

#: Edges up to which one task finishes a graph; they are counted first.
LOCAL_EDGES = 20_000


def _least(edges: DataFrame) -> DataFrame:
    """c, m: each node's smallest neighbour; partial minima are shuffled, at most one a node and map task.

    Staged, so that the joins below have plain exchanges on both sides and Spark splits a node of very many edges.
    """
    return stage(edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
    return both.where("v > u").join(_least(both), F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.least("c", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    lifted = edges.join(least, F.col("u") == F.col("c")).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lifted.union(least.toDF("u", "v"))


def _finished(edges: DataFrame) -> DataFrame:
    """The components of a counted, small number of edges by one task."""
    kind = edges.schema["u"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict = {}

        def root(x):
            while (y := above.setdefault(x, x)) != x:
                above[x] = x = above[y]
            return x

        type_ = pa.string()
        for batch in batches:
            type_ = batch.column(0).type
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                u, v = root(u), root(v)
                if u != v:
                    above[max(u, v)] = min(u, v)
        nodes = list(above)
        yield pa.record_batch([pa.array(nodes, type_), pa.array([root(x) for x in nodes], type_)], names=["node", "component"])

    return map_arrow(edges.select("u", "v").coalesce(1), run, f"node {kind}, component {kind}").where("node IS NOT NULL")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", *, rounds: int = 60, local: int = LOCAL_EDGES) -> DataFrame:
    """node, component for every node that has an edge to another; component is the smallest node.

    Rows with a null end are no edges. A round keeps at most as many edges as it gets, groups
    only by partial aggregates and joins (which Spark can split where a node is in very many
    edges), and is written to the shared folder. Rounds end when the edges are stars around
    their smallest node, which the second star step leaves as they are. Graphs of up to ``local`` edges are finished by one
    task instead (0: never).
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    now, before = stage(now, "edges"), None
    if local and now.count() <= local:
        return _finished(now)
    for _ in range(rounds):
        now = stage(_small_star(stage(_large_star(now).distinct(), "edges")).distinct(), "edges")
        after = tuple(now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components still change after {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
