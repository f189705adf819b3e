"""Texts whose sets of word shingles are alike: what SimHash's few bits can't tell, joined and compared exactly.

Two texts are near copies if the Jaccard similarity of their sets of ``shingle``-word shingles (lower-cased
as in ``simhash``) is at least ``similarity``. At 0.8 their SimHashes differ in about ten of 64 bits, which no
allocation of thresholds to parts makes selective; so candidates come from keys of the sets themselves:

1. a text has BANDS keys, each of the smallest hashes of its set under ROWS orders. Sets of similarity J share a
   key with probability 1 - (1 - J ** ROWS) ** BANDS: all but 5e-8 of the pairs at 0.8, less above it;
2. in a few rounds each text is compared with one other: each key names its most central text (that which shares
   keys with most others), and of those a text takes the one named most often. Links make components, and keys
   within one component are done with. So a large group of near copies becomes one component without its
   pairs being made;
3. then all pairs of a key's texts in different components are compared. In a key of more than HOT texts
   (a common passage), only pairs that share a second key: pairs at 0.8 share but one with
   probability 1e-6, pairs that share no more than a passage rarely two;
4. before two texts are fetched, 1024 parities a text (of the numbers of shingles by hash) are compared: they
   differ in no more bits than the sets in shingles, so that this loses nothing, and up to a thousand
   words leaves little but what is alike.

Links are verified by the sets themselves, from the whole texts. They connect all texts that are alike;
pairs inside a component aren't all listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.text import Batch, Rolling, lowered, mix, steps
from kinfold.operators.components import connected_components
from kinfold.storage import stage
from kinfold.workers import map_arrow

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 4
#: Longs of parities a text.
LONGS = 16
#: Rounds of links to one text of a key before pairs are made, and texts of a key from which pairs must share two.
ROUNDS, HOT = 2, 128
#: Texts to be compared whose hashes are broadcast to fetch them; beyond, the texts are shuffled.
BROADCAST_TEXTS = 100_000


def shingle_hashes(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and how many each text has (of fewer words, one)."""
    b = Batch(texts)
    b.data = lowered(b.data)
    n = np.diff(b.first)
    rolling, count = Rolling(b.word_hashes(), 2), np.where(n == 0, 0, np.maximum(n - shingle + 1, 1))
    lead = np.repeat(b.first[:-1] - np.cumsum(count) + count, count) + np.arange(count.sum())
    return rolling.of(lead, np.minimum(lead + shingle, np.repeat(b.first[1:], count))), count


def _orders() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))
    return (seeds[::2] >> np.uint64(32)).astype(np.uint32), (seeds[1::2] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def band_keys(texts: pa.Array, shingle: int) -> tuple[np.ndarray, ...]:
    """Which texts have shingles; their keys (a row of BANDS each), sizes of sets, and parities (LONGS each)."""
    found, count = shingle_hashes(texts, shingle)
    has = np.flatnonzero(count)
    # Each set once: equal shingles of a text are neighbours after the sort.
    row = np.repeat(np.arange(len(count)), count)
    by = np.lexsort((found, row))
    row, found = row[by], found[by]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    row, found = row[first], found[first]
    size = np.bincount(row, minlength=len(count))
    if not len(has):
        return has, np.zeros((0, BANDS), np.int64), size[has], np.zeros((0, LONGS), np.int64)
    edges, short = (np.cumsum(size) - size)[has], (found >> np.uint64(32)).astype(np.uint32)
    least = np.stack([np.minimum.reduceat((short ^ x) * a, edges) for x, a in zip(*_orders())], axis=1).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :].repeat(len(has), 0)
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least[:, r::ROWS])
    bits = 64 * LONGS
    odd = np.bincount(row * bits + (found % np.uint64(bits)).astype(np.int64), minlength=len(count) * bits).reshape(-1, bits)[has] & 1
    return has, key.view(np.int64), size[has], np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


_PARITIES = tuple(f"p{k}" for k in range(LONGS))


def _bands(docs: DataFrame, shingle: int) -> DataFrame:
    """h, keys, n, p0 and so on of each text that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            has, keys, n, odd = band_keys(batch.column("text"), shingle)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(has) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
            columns = [batch.column("h").take(pa.array(has)), lists, pa.array(n.astype(np.int32)), *(pa.array(np.ascontiguousarray(odd[:, k])) for k in range(LONGS))]
            yield pa.record_batch(columns, names=["h", "keys", "n", *_PARITIES])

    return map_arrow(docs.select("h", "text"), run, "h long, keys array<long>, n int, " + ", ".join(f"{p} long" for p in _PARITIES))


def similarities(left: pa.Array, right: pa.Array, shingle: int) -> np.ndarray:
    """The Jaccard similarity of the two sets of each row; without shingles on either side, 0."""
    sides = [(f, np.concatenate(([0], np.cumsum(n)))) for f, n in (shingle_hashes(x, shingle) for x in (left, right))]
    out = np.zeros(len(left))
    for i in range(len(left)):
        x, y = (np.unique(f[at[i] : at[i + 1]]) for f, at in sides)
        both = len(np.unique(np.concatenate((x, y))))
        out[i] = (len(x) + len(y) - both) / max(both, 1)
    return out


def _ends(bands: DataFrame) -> list[DataFrame]:
    return [bands.select(F.col("h").alias(end), *[F.col(c).alias(c + end) for c in ("n", *_PARITIES)]) for end in "ab"]


def _may_be(similarity: float) -> Column:
    """Whether sizes and parities of both ends allow the similarity."""
    differ = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"{p}a").bitwiseXOR(F.col(f"{p}b"))) for p in _PARITIES))
    fits = F.least("na", "nb") >= similarity * F.greatest("na", "nb") - 1e-9
    return fits & (differ <= (F.col("na") + F.col("nb")) * ((1 - similarity) / (1 + similarity)) + 1e-6)


def _alike(near: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Of a, b those whose sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for wide in steps(batches, "ta"):
            for batch in steps([wide], "tb"):
                found = pa.array(similarities(batch.column("ta"), batch.column("tb"), shingle) >= similarity - 1e-9)
                yield pa.record_batch([batch.column("a").filter(found), batch.column("b").filter(found)], names=["a", "b"])

    wanted = stage(near.select(F.col("a").alias("w")).union(near.select("b")).distinct(), "wanted-texts")
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_TEXTS else wanted
    texts = stage(docs.join(few, F.col("h") == F.col("w")).select("h", "text").dropDuplicates(["h"]), "pair-texts")
    left, right = texts.toDF("ha", "ta"), texts.toDF("hb", "tb")
    return stage(map_arrow(near.join(left, F.col("a") == F.col("ha")).join(right, F.col("b") == F.col("hb")).select("a", "b", "ta", "tb"), run, "a long, b long"), "alike")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _open(keys: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """key, h, c: the rows of keys whose texts lie in more than one component c."""
    if found is not None:
        keys = keys.select("key", "h").join(connected_components(found), F.col("h") == F.col("node"), "left").select("key", "h", F.coalesce("component", "h").alias("c"))
        keys = stage(keys, "placed")
    many = keys.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select(F.col("key").alias("k"))
    return stage(keys.join(stage(many, "open"), F.col("key") == F.col("k")).select("key", "h", "c"), "open-keys")


def _pairs(rows: DataFrame, bands: DataFrame, similarity: float) -> DataFrame:
    """The pairs of a key's texts in different components that may be alike."""
    wide = stage(rows.join(bands.select("h", "n", *_PARITIES), "h"), "wide")
    left, right = (wide.select(F.col("key").alias(key), F.col("h").alias(end), *[F.col(c).alias(c + end) for c in ("c", "n", *_PARITIES)]) for key, end in (("key", "a"), ("k", "b")))
    return left.join(right, (F.col("key") == F.col("k")) & (F.col("ca") != F.col("cb")) & (F.col("a") < F.col("b")) & _may_be(similarity)).select("a", "b")


def links(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """a, b: text hashes that are alike, enough of the pairs to connect all that are; ``docs`` has h (equal texts have equal ones) and text."""
    bands = stage(_bands(docs, shingle).dropDuplicates(["h"]), "bands")
    keys = _open(bands.select(F.explode("keys").alias("key"), "h", F.col("h").alias("c")))
    found = tested = None
    left, right = _ends(bands)
    for salt in range(ROUNDS):
        sizes = stage(keys.groupBy("key").agg(F.count("*").alias("m")).withColumnRenamed("key", "k"), "sizes")
        shares = keys.join(sizes, F.col("key") == F.col("k")).groupBy("h").agg(F.sum("m").alias("m")).withColumnRenamed("h", "x")
        rated = stage(keys.join(stage(shares, "shares"), F.col("h") == F.col("x")).select("key", "h", "c", F.struct("m", F.xxhash64("h", F.lit(salt)).alias("o"), "h", "c").alias("p")), "rated")
        best = rated.groupBy("key").agg(F.max("p").alias("best")).withColumnRenamed("key", "k")
        met = rated.join(stage(best, "best"), F.col("key") == F.col("k")).where(F.col("best.c") != F.col("c")).groupBy("h", F.col("best.h").alias("other")).agg(F.count("*").alias("n"))
        if tested is not None:
            both = tested.union(tested.select(F.col("b"), F.col("a"))).toDF("h", "other")
            met = met.join(both, ["h", "other"], "left_anti")
        pairs = met.groupBy("h").agg(F.max(F.struct("n", "other")).alias("m")).select(*_ordered("h", "m.other")).distinct()
        pairs = stage(pairs, "pairs")
        near = stage(pairs.join(left, "a").join(right, "b").where(_may_be(similarity)).select("a", "b"), "near-pairs")
        alike = _alike(near, docs, shingle, similarity)
        found, tested = (alike, pairs) if found is None else (found.union(alike), tested.union(pairs))
        keys = _open(keys, found)
    hot = stage(keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select(F.col("key").alias("k")), "hot")
    few = keys.join(hot, F.col("key") == F.col("k"), "left_anti")
    many = keys.join(hot, F.col("key") == F.col("k"), "left_semi").groupBy("h", "c").agg(F.sort_array(F.collect_list("key")).alias("ks"))
    two = F.flatten(F.transform("ks", lambda x, i: F.transform(F.slice("ks", i + 2, F.size("ks")), lambda y: F.xxhash64(x, y))))
    pairs = _pairs(few.union(_open(many.select(F.explode(two).alias("key"), "h", "c"))), bands, similarity)
    pairs = stage(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "near-pairs")
    return found.union(_alike(pairs, docs, shingle, similarity))
