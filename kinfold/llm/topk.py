"""Exact top-k search by block-at-a-time pruning.

Vectors are documents whose terms are the components; a component's value is its weight, as an
integer. Documents are put into an order in which neighbours are alike (by the nearest of a few pivots, then
by their product with it) and cut into blocks of that range. A block's forward index holds its vectors and, for
each term, the largest and smallest weight. The bound of a query on a block is the sum over terms of
the larger of ``q * largest`` and ``q * smallest``: no document of the block scores more.

1. *Seed.* Blocks form shards with bounds of their own. A query is scored against the shard of its highest
   bound; its k-th best there is a floor under its k-th best of all.
2. *Prune.* Only pairs of a query and a shard whose bound reaches the floor go on; queries and documents are
   shuffled for these alone.
3. *Score.* In a shard a query takes blocks in falling order of bounds, scores a whole block at a time through its
   forward index, and stops at the first bound that is below its k-th best score or its floor (an equal bound is still
   scored, for ties go to the smaller id). The k best of each shard are merged by rank.

How much is pruned depends on the vectors: little of it where they lie in all directions alike, most where
they form clusters. Scores are exact: float64 carries them below 2**53, int64 below 2**63, Python's integers where parts of a sum
leave that range; a score that itself is beyond a long raises OverflowError.

Pivots are PIVOTS rows at most (those of the smallest hashes); they set the order of documents, never the result.

Defined results: rows whose id or vector is null, or whose vector holds a null or a non-finite
component, take no part; vectors shorter than the longest of the table count as padded by zeros; a repeated row is
a candidate, and a query, as often as it is there; a row is never a candidate of a query with its id; rows that
share an id with different vectors are queries each; fewer than k candidates are all returned; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.storage import stage
from kinfold.workers import map_arrow, ship

BLOCK = 128
#: Blocks a shard, queries a group, shards a chunk: what one task holds.
SHARD_BLOCKS, GROUP, CHUNK = 32, 1024, 4096
#: Rows that the order of documents is built around, at most; one for every so many documents.
PIVOTS, A_PIVOT = 256, 1024

_NONE, _LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_ANSWER = "row long, query_id long, vec_id long, score long"


def quantised(vector: Column, scale: int = 1024) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    limit = F.lit(float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)), F.lit(False))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def products(q: np.ndarray, d: np.ndarray, *, saturate: bool = False, ignored: np.ndarray | None = None) -> np.ndarray:
    """Exact inner products of all rows of q with all of d.

    The arithmetic is chosen by what these rows can reach, not by the largest components of either side. A product
    beyond a long raises, unless it is ignored, or with ``saturate`` (for bounds) becomes the largest or smallest long.
    """
    # Python's integers where long magnitudes could wrap; the sum over components bounds every product of a row.
    most = float((np.abs(q.astype(float)) @ np.abs(d.astype(float)).max(axis=0, initial=0)).max(initial=0)) * (1 + 1e-9)
    if most < 2**53:
        return (q.astype(float) @ d.T.astype(float)).astype(np.int64)
    if most < 2**63:
        return q @ d.T
    exact = q.astype(object) @ d.T.astype(object)
    over = (np.abs(exact) > _LAST) & (True if ignored is None else ~ignored)
    if not saturate and over.any():
        i, j = (int(x[0]) for x in np.nonzero(over))
        raise OverflowError(f"a score is {exact[i, j]}, beyond a long: components up to {np.abs(q[i].astype(object)).max()} and {np.abs(d[j].astype(object)).max()}")
    return np.clip(exact, -_LAST, _LAST).astype(np.int64)


def bounds(q: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """What no document between ``low`` and ``top`` can exceed."""
    up, down = (products(f(q, 0), x, saturate=True) for f, x in ((np.maximum, top), (np.minimum, low)))
    most = up.astype(float) + down.astype(float)
    return np.where(np.abs(most) < 2**62, up + down, np.where(most > 0, _LAST, -(2**61)))


def search_blocks(queries: pd.DataFrame, docs: pd.DataFrame, k: int) -> tuple[pd.DataFrame, int]:
    """The k best of ``docs`` (key, vec, block) for each query (row, key, vec, floor) as far as they reach its floor, and how many blocks were scored."""
    docs = docs.sort_values(["block", "key"], kind="stable")
    width = max(max(map(len, docs["vec"])), max(map(len, queries["vec"])), 1)
    d, q = _matrix(docs["vec"], width), _matrix(queries["vec"], width)
    keys, own, floor = docs["key"].to_numpy(), queries["key"].to_numpy(), queries["floor"].to_numpy()
    edges = np.flatnonzero(np.diff(docs["block"].to_numpy(), prepend=docs["block"].iloc[0] - 1))
    most = bounds(q, np.maximum.reduceat(d, edges), np.minimum.reduceat(d, edges))
    order = np.argsort(-most, axis=1, kind="stable")
    stops = np.append(edges[1:], len(d))
    best_score, best_key = np.full((len(q), k), _NONE), np.full((len(q), k), _LAST)
    scored = 0
    # All queries take their next block; those that want the same block score it together.
    alive = np.arange(len(q))
    for turn in range(len(edges)):
        block = order[alive, turn]
        keep = most[alive, block] >= np.maximum(best_score[alive, -1], floor[alive])
        alive, block = alive[keep], block[keep]
        if not len(alive):
            break
        scored += len(alive)
        for b in np.unique(block):
            rows = alive[block == b]
            s = slice(edges[b], stops[b])
            mine = own[rows][:, None] == keys[s][None, :]
            score = products(q[rows], d[s], ignored=mine)
            score[mine] = _NONE
            both = np.concatenate((best_score[rows], score), axis=1)
            ids = np.concatenate((best_key[rows], np.broadcast_to(keys[s], score.shape)), axis=1)
            pick = np.lexsort((ids, ~both), axis=1)[:, :k]
            best_score[rows], best_key[rows] = np.take_along_axis(both, pick, 1), np.take_along_axis(ids, pick, 1)
    row, rank = np.nonzero((best_score > _NONE) & (best_score >= floor[:, None]))
    return pd.DataFrame({"row": queries["row"].to_numpy()[row], "query_id": own[row], "vec_id": best_key[row, rank], "score": best_score[row, rank]}), scored


def build_index(rows: DataFrame, width: int, total: int) -> DataFrame:
    """shard, block, kind, key, vec: the documents (kind 0) in blocks of neighbours, and each shard's largest (1) and smallest (2) weights."""
    n = max(1, min(PIVOTS, total // A_PIVOT))
    sample = rows.orderBy(F.xxhash64("key", "vec")).limit(n).select("vec").collect()
    pivots = _matrix([r[0] for r in sample], width).astype(float)
    pivots /= np.maximum(np.linalg.norm(pivots, axis=1, keepdims=True), 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _matrix(batch.column("vec").to_pylist(), width).astype(float) @ pivots.T
            pivot = near.argmax(axis=1) if len(near) else np.zeros(0, np.int64)
            yield pa.record_batch([pa.array(pivot.astype(np.int32)), pa.array(near[np.arange(len(near)), pivot]), *batch.columns], names=["pivot", "near", "key", "vec"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, block, filled, last, held = TaskContext.get().partitionId() << 32, 0, 0, None, []

        def emit():
            d = _matrix([v for _, _, v in held], width)
            vecs = [*(v for _, _, v in held), d.max(axis=0).tolist(), d.min(axis=0).tolist()]
            edge = [0, 0]
            yield pa.record_batch(
                [pa.array([shard] * len(vecs), pa.int64()), pa.array([*(b for b, _, _ in held), *edge], pa.int32()), pa.array([0] * len(held) + [1, 2], pa.int32()), pa.array([*(x for _, x, _ in held), *edge], pa.int64()), pa.array(vecs, pa.list_(pa.int64()))],
                names=["shard", "block", "kind", "key", "vec"],
            )

        for batch in batches:
            for pivot, key, vec in zip(batch.column("pivot").to_pylist(), batch.column("key").to_pylist(), batch.column("vec").to_pylist()):
                if filled == BLOCK or last not in (None, pivot):
                    block, filled = block + 1, 0
                    if block == SHARD_BLOCKS:
                        yield from emit()
                        shard, block, held = shard + 1, 0, []
                held.append((block, key, vec))
                filled, last = filled + 1, pivot
        if held:
            yield from emit()

    placed = map_arrow(rows.select("key", "vec"), place, "pivot int, near double, key long, vec array<long>")
    placed = placed.repartitionByRange("pivot", "near", "key").sortWithinPartitions("pivot", "near", "key")
    return map_arrow(placed, cut, "shard long, block int, kind int, key long, vec array<long>")


def live_pairs(queries: DataFrame, index: DataFrame, *, best: bool = False) -> DataFrame:
    """row, grp, shard, bound: the pairs whose bound reaches the query's floor, or only the best of each query and chunk of shards."""
    edges = index.where("kind > 0").groupBy("shard").agg(F.max(F.when(F.col("kind") == 1, F.col("vec"))).alias("top"), F.max(F.when(F.col("kind") == 2, F.col("vec"))).alias("low"))
    shards, groups = index.where("kind = 1").count(), queries.agg(F.coalesce(F.max("grp"), F.lit(0))).first()[0] + 1
    chunks = max(1, -(-shards // CHUNK))
    over = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    edges = edges.withColumn("chunk", F.pmod(F.xxhash64("shard"), F.lit(chunks)).cast("int")).withColumn("grp", over(groups))
    asked = queries.select("row", "grp", "vec", "floor", over(chunks).alias("chunk"))

    def run(q: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        if q.empty or s.empty:
            return pd.DataFrame({"row": [], "grp": [], "shard": [], "bound": []}).astype("int64")
        width = max(max(map(len, s["top"])), max(map(len, q["vec"])), 1)
        most = bounds(_matrix(q["vec"], width), _matrix(s["top"], width), _matrix(s["low"], width))
        i, j = (np.arange(len(q)), most.argmax(axis=1)) if best else np.nonzero(most >= q["floor"].to_numpy()[:, None])
        return pd.DataFrame({"row": q["row"].to_numpy()[i], "grp": q["grp"].to_numpy()[i], "shard": s["shard"].to_numpy()[j], "bound": most[i, j]})

    return asked.groupBy("chunk", "grp").cogroup(edges.groupBy("chunk", "grp")).applyInPandas(run, "row long, grp int, shard long, bound long")


def score_pairs(pairs: DataFrame, queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """row, query_id, vec_id, score: the k best of each pair's shard for its query."""

    def run(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if q.empty or d.empty:
            return pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
        return search_blocks(q, d, k)[0]

    asked = pairs.select("row", "shard").join(queries, "row").select("shard", "grp", "row", "key", "vec", "floor")
    docs = index.where("kind = 0").join(pairs.select("shard", "grp").distinct(), "shard").select("shard", "grp", "block", "key", "vec")
    return asked.groupBy("shard", "grp").cogroup(docs.groupBy("shard", "grp")).applyInPandas(run, _ANSWER)


def floors(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """``queries`` with the k-th best score of each one's most promising shard as floor."""
    seed = live_pairs(queries, index, best=True).groupBy("row").agg(F.max_by(F.struct("grp", "shard"), F.struct("bound", "shard")).alias("s")).select("row", "s.*")
    found = score_pairs(stage(seed, "seeds"), queries, index, k).groupBy("row").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k)
    return queries.join(found, "row", "left").select("row", "grp", "key", "vec", "copies", F.coalesce("least", "floor").alias("floor"))


def top_k(vectors: DataFrame, is_query: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score for every row where ``is_query`` holds."""
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("v"), is_query.alias("is_query")).where(F.col("key").isNotNull() & usable(F.col("v")))
    rows = stage(rows.select("key", quantised(F.col("v"), scale).alias("vec"), "is_query"), "vectors")
    total, asked, width = rows.agg(F.count("*"), F.count_if("is_query"), F.max(F.size("vec"))).first()
    ship(vectors.sparkSession)
    index = stage(build_index(rows, max(width or 0, 1), total), "blocks")
    row = F.xxhash64("key", "vec")
    queries = rows.where("is_query").groupBy("key", "vec").agg(F.count("*").alias("copies"))
    queries = queries.select(row.alias("row"), F.pmod(row, F.lit(max(1, -(-asked // GROUP)))).cast("int").alias("grp"), "key", "vec", "copies", F.lit(int(_NONE)).alias("floor"))
    queries = stage(floors(stage(queries, "queries"), index, k), "floors")
    found = score_pairs(stage(live_pairs(queries, index), "live"), queries, index, k)
    best = Window.partitionBy("query_id", "row").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    # A query that is there several times is answered as often.
    again = queries.where("copies > 1").select(F.col("row").alias("r"), "copies")
    ranked = ranked.join(again, F.col("row") == F.col("r"), "left").withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1).cast("long")))))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.n, q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * d.e[i])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
