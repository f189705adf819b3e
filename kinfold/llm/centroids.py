"""Centroid clustering of integer vectors with partial-distance search.

Every vector of exactly 64 finite components becomes 64 integers, floor(256 * x). Centroids start as the vectors
whose ids have the smallest hashes. A round assigns each vector to its nearest centroid and moves every centroid
that has vectors to the floor of their mean, exact in integers of any size.

The search takes dimensions in falling order of their variance over the whole table, in ``BLOCKS``. The squared
differences of the first block to all centroids choose a first candidate, whose full distance is the best so far. Every other
centroid is dropped for a vector as soon as its partial sum is strictly above the vector's best; those that remain
finish all 64 dimensions, and equal distances go to the smaller number. Partial sums only grow, so that nothing that
could win is dropped.

What goes to the driver is bounded by the model: the centroids, and per centroid the sums of its vectors, added up
on the executors as integers cut into 32-bit limbs.

Defined results: vectors that are null, of another length, or hold a null or non-finite component take no part;
repeated rows are clustered each for itself; rows of one id start centroids in the order of their packed bytes, null
ids last; fewer vectors than centroids make as many centroids as there are vectors; an empty table gives no rows; a
distance or inertia beyond the largest long is null (assignments and centroids stay exact); other columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.storage import stage
from kinfold.workers import map_arrow

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SALT = "2"
#: Ends of the blocks of dimensions after which partial sums are compared.
BLOCKS = (8, 16, 32, 64)
#: Integers up to here take part as int64: 64 squares of differences stay below 2**63.
SMALL = 2**27
LONGEST = 2**63 - 1
#: Vectors that are compared at a time.
STEP = 4096


def _integers(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows that are kept, and their components as doubles."""
    kept = np.flatnonzero(pc.equal(pc.list_value_length(lists), DIMENSIONS).fill_null(False).to_numpy(zero_copy_only=False))
    flat = lists.take(pa.array(kept)).flatten().cast(pa.float64()).fill_null(math.nan)
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
    finite = np.isfinite(x).all(axis=1)
    return kept[finite], x[finite]


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, packed (64 little-endian int32), big (decimals joined by commas, only where a component is above SMALL)."""
    kind = vectors.schema[vec_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, x = _integers(batch.column("vector"))
            with np.errstate(over="ignore"):
                v = np.floor(x * SCALE)
            small = (np.abs(v) <= SMALL).all(axis=1)
            packed = [row.tobytes() if ok else None for row, ok in zip(np.where(small[:, None], v, 0).astype("<i4"), small)]
            # A double above 2**53 is an integer; smaller ones are scaled without loss.
            big = [None if ok else ",".join(str(int(c) * SCALE if abs(c) > 2**53 else math.floor(c * SCALE)) for c in row.tolist()) for row, ok in zip(x, small)]
            yield pa.record_batch([batch.column("vec_id").take(pa.array(kept)), pa.array(packed, pa.binary()), pa.array(big, pa.string())], names=["vec_id", "packed", "big"])

    return map_arrow(vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")), run, f"vec_id {kind}, packed binary, big string")


def _unpack(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, integers) of a batch in steps: int64 where they are small, Python's integers where not."""
    packed = batch.column("packed")
    at = np.flatnonzero(packed.is_valid().to_numpy(zero_copy_only=False))
    for i in range(0, len(at), STEP):
        part = at[i : i + STEP]
        yield part, np.frombuffer(b"".join(packed.take(pa.array(part)).to_pylist()), "<i4").reshape(-1, DIMENSIONS).astype(np.int64)
    rest = np.flatnonzero(packed.is_null().to_numpy(zero_copy_only=False))
    for i in range(0, len(rest), STEP):
        part = rest[i : i + STEP]
        yield part, np.array([[int(c) for c in row.split(",")] for row in batch.column("big").take(pa.array(part)).to_pylist()], object)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row and its squared distance; dimensions stand in the order in which they are taken.

    Both are int64 with entries up to SMALL, or hold Python's integers.
    """
    n, k = len(x), len(centroids)
    square = lambda a, b: ((a - b) ** 2).sum(axis=-1)
    head = np.stack([square(x[:, : BLOCKS[0]], c[: BLOCKS[0]]) for c in centroids], axis=1)
    first = head.argmin(axis=1)
    best, found = square(x, centroids[first]), first.copy()
    for j in range(k):
        alive = np.flatnonzero((head[:, j] <= best) & (first != j))
        d = head[alive, j]
        for a, b in zip(BLOCKS, BLOCKS[1:]):
            if not len(alive):
                break
            d = d + square(x[alive, a:b], centroids[j, a:b])
            go = d <= best[alive]
            alive, d = alive[go], d[go]
        won = (d < best[alive]) | ((d == best[alive]) & (j < found[alive]))
        best[alive[won]], found[alive[won]] = d[won], j
    return found, best


def _assigner(centroids: list[list[int]], order: list[int]):
    """A function from integers to (cluster, distance)."""
    exact = np.array(centroids, object)[:, order]
    fast = exact.astype(np.int64) if all(abs(c) <= SMALL for row in centroids for c in row) else None

    def assign(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if fast is not None and x.dtype == np.int64:
            return nearest(x[:, order], fast)
        return nearest(x[:, order].astype(object), exact)

    return assign


def _limbs(sums: list[int]) -> Iterator[list[int]]:
    """Integers as limbs from the lowest, all below 2**36 in size, so that limbs of 2**27 tasks add up in a long."""
    while any(abs(s) >= 2**36 for s in sums):
        yield [s & 0xFFFFFFFF for s in sums]
        sums = [s >> 32 for s in sums]
    yield sums


def _order(staged: DataFrame) -> list[int]:
    """Dimensions by falling variance over the vectors of small integers; which order is taken changes no result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, one, two = 0, np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
        for batch in batches:
            for _, x in _unpack(batch):
                if x.dtype == object:
                    continue
                x = x.astype(float)
                n, one, two = n + len(x), one + x.sum(axis=0), two + (x * x).sum(axis=0)
        yield pa.record_batch([pa.array(range(DIMENSIONS)), pa.array([float(n)] * DIMENSIONS), pa.array(one), pa.array(two)], names=["dimension", "n", "one", "two"])

    rows = map_arrow(staged.select("packed", "big"), run, "dimension long, n double, one double, two double").groupBy("dimension").agg(F.sum("n"), F.sum("one"), F.sum("two")).collect()
    variance = {d: two / n - (one / n) ** 2 if n else 0.0 for d, n, one, two in rows}
    return sorted(range(DIMENSIONS), key=lambda d: (-variance.get(d, 0.0), d))


def _means(staged: DataFrame, centroids: list[list[int]], order: list[int]) -> list[list[int]]:
    """Every centroid moved to the floor of its vectors' mean; those without vectors stay."""
    assign = _assigner(centroids, order)
    names = [f"s{d}" for d in range(DIMENSIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = [0] * len(centroids), np.zeros((len(centroids), DIMENSIONS), object)
        for batch in batches:
            for _, x in _unpack(batch):
                found, _ = assign(x)
                for c in np.unique(found).tolist():
                    mine = x[found == c]
                    counts[c] += len(mine)
                    sums[c] += mine.sum(axis=0).astype(object)
        rows = [(c, i, counts[c] if i == 0 else 0, *limb) for c in range(len(centroids)) if counts[c] for i, limb in enumerate(_limbs([int(s) for s in sums[c]]))]
        columns = list(zip(*rows)) or [[]] * (3 + DIMENSIONS)
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["cluster", "limb", "n", *names])

    schema = ", ".join(f"{c} long" for c in ("cluster", "limb", "n", *names))
    added = map_arrow(staged.select("packed", "big"), run, schema).groupBy("cluster", "limb").agg(F.sum("n"), *[F.sum(c) for c in names]).collect()
    counts, sums = [0] * len(centroids), [[0] * DIMENSIONS for _ in centroids]
    for c, limb, n, *parts in added:
        counts[c] += n
        sums[c] = [s + (p << (32 * limb)) for s, p in zip(sums[c], parts)]
    return [[s // n for s in row] if n else old for old, row, n in zip(centroids, sums, counts)]


def _start(staged: DataFrame, k: int, salt: str) -> list[list[int]]:
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = staged.orderBy(digest.asc_nulls_last(), F.col("packed").asc_nulls_last(), "big").limit(k).select("packed", "big").collect()
    return [[int(c) for c in r.big.split(",")] if r.packed is None else np.frombuffer(r.packed, "<i4").tolist() for r in rows]


def cluster(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = SALT) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance of every vector that takes part; the final centroids)."""
    kind = vectors.schema[vec_id].dataType.simpleString()
    staged = stage(quantised(vectors, vec_id, vector), "vectors")
    centroids = _start(staged, k, salt)
    if not centroids:
        return staged.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), []
    order = _order(staged)
    for _ in range(rounds):
        centroids = _means(staged, centroids, order)
    assign = _assigner(centroids, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _unpack(batch):
                found, far = assign(x)
                far = pa.array([d if d <= LONGEST else None for d in far.tolist()], pa.int64())
                yield pa.record_batch([batch.column("vec_id").take(pa.array(at)), pa.array(found.astype(np.int32)), far], names=["vec_id", "cluster", "distance"])

    return map_arrow(staged, run, f"vec_id {kind}, cluster int, distance long"), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and centroid_sha256."""
    assigned = stage(assigned, "assigned")
    total = F.when(F.count_if(F.col("distance").isNull()) == 0, F.sum(F.col("distance").cast("decimal(19,0)")))
    rows = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(total.alias("total")).collect()}
    fits = lambda x: F.lit(None if x is None or x > LONGEST else int(x)).cast("long")
    own = F.array(*[fits(rows.get(c, 0)) for c in range(len(centroids))]) if centroids else F.array(fits(None))
    sha = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids]) if centroids else F.array(F.lit(""))
    every = None if None in rows.values() else sum(rows.values())
    return assigned.select("vec_id", "cluster", "distance", F.get(own, F.col("cluster")).alias("cluster_inertia"), fits(every).alias("inertia"), F.get(sha, F.col("cluster")).alias("centroid_sha256"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(*cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def _sql() -> str:
    """The rounds written out: vectors as rows of (row, dimension, component)."""
    parts = [
        f"""kept AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS})""",
        f"""v AS MATERIALIZED (SELECT r, unnest(range({DIMENSIONS})) AS d, CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM kept)""",
        f"""first AS (SELECT r, row_number() OVER (ORDER BY sha256('{SALT}:' || CAST(vec_id AS VARCHAR))) - 1 AS c FROM kept QUALIFY c < {CENTROIDS})""",
        "c0 AS MATERIALIZED (SELECT c, d, x FROM first JOIN v USING (r))",
    ]
    for i in range(ROUNDS + 1):
        parts.append(f"""far{i} AS (SELECT v.r, c{i}.c, sum((v.x - c{i}.x) * (v.x - c{i}.x)) AS far FROM v JOIN c{i} USING (d) GROUP BY v.r, c{i}.c)""")
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, c, far FROM far{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY far, c) = 1)""")
        if i < ROUNDS:
            mean = "(sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*)"
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, d, coalesce(m.x, c{i}.x) AS x FROM c{i} LEFT JOIN (SELECT c, d, {mean} AS x FROM a{i} JOIN v USING (r) GROUP BY c, d) m USING (c, d))""")
    last = ROUNDS
    parts.append(f"""sha AS (SELECT c, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{last} GROUP BY c)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(far AS BIGINT) AS distance, CAST(sum(far) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(far) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{last} JOIN kept USING (r) JOIN sha USING (c)"""


ORACLE_SQL = _sql()
