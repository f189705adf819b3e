"""SimHash near duplicates by the generalised pigeonhole principle.

``fingerprints`` makes one 64-bit SimHash a document. ``link`` finds every pair of fingerprints
that differ in at most ``max_bits`` bits, and ``near_duplicates`` the classes they form:

1. the 64 x 64 co-occurrence counts of bits over all distinct fingerprints give correlations;
   correlated bits are put into the same part, so that the other parts stay selective;
2. a pair within ``max_bits`` has a part i in which it differs in at most t_i bits, if
   sum(t_i) = max_bits - parts + 1 (t_i = -1: part not probed). Dynamic programming over the
   parts allocates the t_i that minimise keys plus estimated candidates; the number of parts is
   chosen in the same way, so that more documents get more selective parts;
3. "part i differs in at most t bits" is an equality: of the fingerprints masked by part i less
   some t bits. Each mask is a probe key; equal keys make candidates, bit counts verify them;
4. inside a bucket of more than ``BUCKET`` fingerprints no pairs are made: two fingerprints differ
   in at most two bits just if their balls of radius one meet, so members are linked to the
   smallest member around each of their 65 ball points.

Defined results: null and empty texts have fingerprint zero and are linked like any other; repeated
rows are each a row of the result; a null doc_id never names a class unless a class has no other;
columns beside the named ones don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.text import Batch, lowered, steps
from kinfold.operators.components import connected_components
from kinfold.storage import stage
from kinfold.workers import map_arrow

#: Fingerprints in a bucket from which pairs give way to ball points: up to here a member is in
#: fewer pairs than it has ball points, (BUCKET - 1) / 2 < 65.
BUCKET = 130
#: Cost of a probe key in units of a candidate pair.
KEY_COST = 2.0


def simhashes(texts: pa.Array, shingle: int = 3) -> np.ndarray:
    """One fingerprint a text, as signed 64-bit values."""
    import xxhash

    b = Batch(texts)
    data, size = lowered(b.data), b.stop - b.start
    # The words of all texts, lower-cased and joined by one space.
    place = np.concatenate(([0], np.cumsum(size + 1)))
    joined = np.full(place[-1], 32, np.uint8)
    shift = np.repeat(b.start - place[:-1], size)
    at = np.arange(len(shift)) + np.repeat(np.arange(len(size)), size)
    joined[at] = data[at + shift]
    joined = joined.tobytes()
    count = np.diff(b.first)
    n = np.where(count == 0, 0, np.maximum(count - shingle + 1, 1))
    lead = np.repeat(b.first[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    last = np.minimum(lead + shingle, np.repeat(b.first[1:], n)) - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[i:j], 42) for i, j in zip(place[lead].tolist(), (place[last] + size[last]).tolist())), np.uint64, len(lead))
    out = np.zeros(len(texts), np.uint64)
    has = np.flatnonzero(n)
    if len(has):
        bits = np.unpackbits(h.byteswap().view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, np.cumsum(n)[has] - n[has], axis=0, dtype=np.int32)
        out[has] = np.packbits(2 * ones > n[has][:, None], axis=1).view(">u8").ravel().astype(np.uint64)
    return out.view(np.int64)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, fp (long) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            yield pa.record_batch([batch.column("doc_id"), pa.array(simhashes(batch.column("text"), shingle))], names=["doc_id", "fp"])

    return map_arrow(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), run, "doc_id long, fp long")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints, and how often bits i and j are both set (64 x 64), over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((64, 64))
        for batch in batches:
            bits = np.unpackbits(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).byteswap().view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1].astype(np.float32)
            n, total = n + len(bits), total + bits.T @ bits
        yield pa.record_batch([pa.array([-1, *range(4096)]), pa.array([n, *total.astype(np.int64).ravel().tolist()])], names=["cell", "n"])

    cells = dict(map(tuple, map_arrow(fps.select("fp"), run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect()))
    return cells.pop(-1, 0), np.array([cells.get(i, 0) for i in range(4096)], float).reshape(64, 64)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of nearly equal size; each starts from the freest bit left and takes those most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    left, out = set(range(64)), []
    for k in range(parts, 0, -1):
        size = -(-len(left) // k)
        part = [min(left, key=lambda i: (abs(p[i] - 0.5), i))]
        left -= set(part)
        while len(part) < size:
            nearest = max(left, key=lambda i: (corr[i, part].sum(), -i))
            part.append(nearest)
            left.remove(nearest)
        out.append(sorted(part))
    return out


def _pairs(n: int, p: np.ndarray, part: list[int], t: int) -> float:
    """Expected pairs that differ in at most t bits of the part, bits taken as independent."""
    agree = p[part] ** 2 + (1 - p[part]) ** 2
    poly = np.array([1.0])
    for a in agree:
        poly = np.convolve(poly, [a, 1 - a])
    return n * n / 2 * poly[: t + 1].sum()


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds of the parts that sum to ``total`` at the least cost, by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for done, (spent, chosen) in best.items():
            for t, c in cost.items():
                found = (spent + c, [*chosen, t])
                if done + t not in step or found[0] < step[done + t][0]:
                    step[done + t] = found
        best = step
    return best[total]


def plan_masks(fps: DataFrame, max_bits: int = 2, parts: tuple[int, ...] = (2, 3, 4)) -> list[int]:
    """The masks under which equal fingerprints are candidates."""
    n, both = bit_counts(fps)
    p = np.diag(both) / max(n, 1)
    split = {m: group_bits(n, both, m) for m in parts}
    # Exact pairs of equal values in each part correct the estimate for the bits' dependence.
    mask = lambda bits: sum(1 << i for i in bits)
    all_parts = [(m, i, mask(part)) for m in parts for i, part in enumerate(split[m])]
    keys = fps.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(x))).alias("key")) for k, (_, _, x) in enumerate(all_parts)])).alias("t"))
    found = dict(map(tuple, keys.groupBy("t.k", "t.key").agg(F.count("*").alias("c")).groupBy("k").agg(F.sum(F.expr("c * (c - 1D) / 2"))).collect()))
    options = []
    for m in parts:
        costs = []
        for i, part in enumerate(split[m]):
            exact = found.get(next(k for k, x in enumerate(all_parts) if x[:2] == (m, i)), 0.0)
            more = max(1.0, (exact + 1) / (_pairs(n, p, part, 0) + 1))
            costs.append({-1: 0.0} | {t: KEY_COST * n * comb(len(part), t) + more * _pairs(n, p, part, t) * comb(len(part), t) ** 0.5 for t in range(min(max_bits, len(part) - 1) + 1)})
        cost, thresholds = allocate(costs, max_bits - m + 1)
        options.append((cost, [mask(part) & ~mask(drop) for part, t in zip(split[m], thresholds) if t >= 0 for drop in combinations(part, t)]))
    return min(options)[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def link(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """a, b: fingerprints that differ in at most two bits, enough of the pairs to connect all that are linked."""
    if max_bits != 2:
        raise ValueError("ball points stand for two bits; other thresholds need another cover of hot buckets")
    masks = plan_masks(fps, max_bits)
    keys = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(masks)])).alias("t")).select("fp", "t.mask", "t.key")
    shared = keys.groupBy("mask", "key").agg(F.count("*").alias("members")).where("members > 1")
    found = stage(keys.join(shared, ["mask", "key"]), "buckets")
    small = found.where(F.col("members") <= BUCKET)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = small.select("mask", "key", F.col("fp").alias("a")).join(small.select("mask", "key", F.col("fp").alias("b")), ["mask", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
    hot = found.where(F.col("members") > BUCKET).select("fp").distinct()
    balls = stage(hot.select("fp", F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])).alias("point")), "balls")
    centre = balls.groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    around = balls.join(centre, "point").where(F.col("fp") != F.col("a")).select("a", F.col("fp").alias("b"))
    return pairs.union(around).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, fp, component_id for every row: the smallest doc_id reachable by links."""
    rows = stage(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    fps = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    nodes = stage(connected_components(link(fps)), "components")
    lowest = nodes.join(fps, F.col("node") == F.col("fp")).groupBy(F.col("component").alias("c")).agg(F.min("least").alias("component_id"))
    named = nodes.join(lowest, F.col("component") == F.col("c")).select("node", "component_id")
    # Staged, so that the join below has plain exchanges and Spark splits very common fingerprints.
    named = fps.join(named, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("f"), F.coalesce("component_id", "least").alias("component_id"))
    named = stage(named, "named")
    return rows.join(named, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
