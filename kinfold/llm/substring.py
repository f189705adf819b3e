"""Substring dedup by seed and extend: words inside a repeated passage of ``length`` words are removed.

A window is ``length`` consecutive words of one document. It is repeated if its word sequence also
starts anywhere else, in another document or in the same one. The operator finds every word
covered by a repeated window without listing all windows:

* *Seeds.* Of the ``length - seed + 1`` seeds (runs of ``seed`` words) in a window, winnowing selects
  the one with the smallest hash (the last of equals). Equal windows select equal seeds at equal
  offsets, so each window belongs to exactly one anchor, and the windows of an anchor are
  neighbours: its *context* is the stretch of words they cover.
* *Join.* Documents are joined on anchors: anchors that occur once are done with.
* *Extend.* Occurrences of an anchor whose whole contexts are equal repeat all the windows of the
  context; no pair of them is made. Where contexts of one anchor differ, one occurrence of each
  distinct context is extended from the seed to both sides, one window for each offset, and
  windows that meet another context's are repeated.
* *Keep.* The repeated windows of a document, merged where they touch, are its maximal repeats.

Windows and contexts are compared by two hashes of 64 bits made of polynomials over words, one modulo 2**64 and one
modulo a prime.

Defined results: null is a text without words; a text shorter than the window keeps all its words;
repeated rows repeat each other's windows; rows may share a doc_id (they are told apart by their
text); an empty table gives an empty result; columns beside the named ones are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.text import Batch, Rolling, steps, unused
from kinfold.storage import stage
from kinfold.workers import map_arrow

LENGTH = 35
SEED = 12

_ANCHORS = "doc_id long, text_hash long, anchor long, context long, low int, high int"
_SPANS = "doc_id long, text_hash long, w1 long, w2 long, at int"


def _hashes(b: Batch) -> tuple[Rolling, Rolling]:
    return Rolling(b.word_hashes(1), 1), Rolling(b.word_hashes(3), 2)


def _starts(b: Batch, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The first word of every window, and the number of windows of each text."""
    n = np.maximum(np.diff(b.first) - length + 1, 0)
    shift = np.repeat(b.first[:-1] - np.cumsum(n) + n, n)
    return shift + np.arange(n.sum()), n


def _select(seeds: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """For each window the place of the smallest of its ``width`` seeds, the last of equals.

    A sliding minimum by doubling: after a step of size k, slot i has the minimum of k seeds from i.
    """
    best, k = np.arange(len(seeds)), 1
    while k < width:
        step = min(k, width - k)
        later = best[step:]
        head = best[: len(later)]
        best = np.where(seeds[later] <= seeds[head], later, head)
        k += step
    return best[starts]


def anchors_of(texts: pa.Array, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """row, anchor, context hash, first and last window start (words from the text's start) of every anchor."""
    b = Batch(texts)
    starts, n = _starts(b, length)
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    one, two = _hashes(b)
    words = len(b.start)
    place = np.arange(words - seed + 1)
    seeds = one.of(place, place + seed)
    chosen = _select(seeds, starts, length - seed + 1)
    row = np.repeat(np.arange(len(n)), n)
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    low = np.flatnonzero(new)
    high = np.append(low[1:], len(starts)) - 1
    first, last, at = starts[low], starts[high], chosen[low]
    # The seed's place inside the context is part of what is compared.
    context = two.of(first, last + length) ^ (at - first).astype(np.uint64)
    base = b.first[row[low]]
    return row[low], seeds[at].view(np.int64), context.view(np.int64), first - base, last - base


def anchors(docs: DataFrame, length: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            row, anchor, context, low, high = anchors_of(batch.column("text"), length, seed)
            row = pa.array(row)
            yield pa.record_batch(
                [batch.column("doc_id").take(row), batch.column("text_hash").take(row), pa.array(anchor), pa.array(context), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
                names=["doc_id", "text_hash", "anchor", "context", "low", "high"],
            )

    return map_arrow(docs, run, _ANCHORS)


def windows(docs: DataFrame, length: int) -> DataFrame:
    """Both hashes of each window whose start lies in one of the row's ``spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            b = Batch(batch.column("text"))
            one, two = _hashes(b)
            spans = batch.column("spans")
            count = np.diff(np.asarray(spans.offsets))
            low, high = (np.asarray(x) for x in spans.flatten().flatten())
            row = np.repeat(np.arange(batch.num_rows), count)
            size = high - low + 1
            start = np.repeat(b.first[row] + low - np.cumsum(size) + size, size) + np.arange(size.sum())
            row = np.repeat(row, size)
            take = pa.array(row)
            yield pa.record_batch(
                [batch.column("doc_id").take(take), batch.column("text_hash").take(take), pa.array(one.of(start, start + length).view(np.int64)), pa.array(two.of(start, start + length).view(np.int64)), pa.array((start - b.first[row]).astype(np.int32))],
                names=["doc_id", "text_hash", "w1", "w2", "at"],
            )

    return map_arrow(docs, run, _SPANS)


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, text_hash, spans: window starts low to high, each of which is repeated; ``docs`` has doc_id, text, text_hash."""
    found = stage(anchors(docs, length, seed), "anchors")
    counts = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("context").alias("a"), F.max("context").alias("z"))
    # Staged, so that the join has plain exchanges on both sides and Spark splits very common anchors.
    counts = stage(counts.where("n > 1").select(F.col("anchor").alias("seed"), (F.col("a") != F.col("z")).alias("differ")), "repeated")
    found = stage(found.join(counts, F.col("anchor") == F.col("seed")).drop("seed"), "shared")
    # One row for each distinct context, with one of its occurrences.
    contexts = found.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.first("differ").alias("differ"), F.min(F.struct("doc_id", "text_hash", "low", "high")).alias("r"))
    contexts = stage(contexts, "contexts")
    twice = contexts.where("n > 1").select(F.col("anchor").alias("a"), F.col("context").alias("c"))
    whole = found.join(twice, (F.col("anchor") == F.col("a")) & (F.col("context") == F.col("c"))).select("doc_id", "text_hash", "low", "high")
    # Contexts that meet other contexts at their anchor are extended from the seed.
    extend = contexts.where("differ").groupBy(F.col("r.doc_id").alias("d"), F.col("r.text_hash").alias("h")).agg(F.collect_list(F.struct("r.low", "r.high")).alias("spans"))
    text = docs.select("doc_id", "text_hash", "text").join(extend, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))).select("doc_id", "text_hash", "text", "spans")
    # A row that is there twice opens its windows twice; they are repeated indeed.
    opened = stage(windows(text, length), "windows")
    met = opened.groupBy(F.col("w1").alias("m1"), F.col("w2").alias("m2")).agg(F.count("*").alias("n")).where("n > 1")
    met = stage(met.select("m1", "m2"), "met")
    edge = opened.join(met, (F.col("w1") == F.col("m1")) & (F.col("w2") == F.col("m2"))).select("doc_id", "text_hash", F.col("at").alias("low"), F.col("at").alias("high"))
    return whole.union(edge).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def cut(texts: pa.Array, spans: pa.ListArray, length: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Kept words joined by one space, n_words and n_removed of each text."""
    b = Batch(texts)
    spans = spans.fill_null([]) if spans.null_count else spans
    count = np.diff(np.asarray(spans.offsets))
    low, high = (np.asarray(x).astype(np.int64) for x in spans.flatten().flatten())
    base = b.first[np.repeat(np.arange(len(count)), count)]
    depth = np.zeros(len(b.start) + 1, np.int64)
    np.add.at(depth, base + low, 1)
    np.add.at(depth, base + high + length, -1)
    keep = np.cumsum(depth[:-1]) == 0
    kept = np.concatenate(([0], np.cumsum(keep)))[b.first]
    start, size = b.start[keep], (b.stop - b.start)[keep]
    # Every kept word but the last of its text is followed by one space.
    gap = np.ones(len(size), np.int64)
    last = kept[1:][np.diff(kept) > 0] - 1
    gap[last] = 0
    place = np.concatenate(([0], np.cumsum(size + gap)))
    data = np.full(place[-1], 32, np.uint8)
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    data[np.repeat(place[:-1], size) + within] = b.data[np.repeat(start, size) + within]
    words = np.diff(b.first)
    out = pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(place[kept].astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))
    return out.cast(pa.string()), words, words - np.diff(kept)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``docs`` with kept (the words left, joined by one space), n_words and n_removed, which replace columns of these names."""
    if not 0 < seed <= length:
        raise ValueError("the seed is a part of the window")
    hashed = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    found = repeats(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), hashed.alias("text_hash")), length, seed)
    d, h, spans = unused(docs.columns, "_d", "_h", "_spans")
    found = found.select(F.col("doc_id").alias(d), F.col("text_hash").alias(h), F.col("spans").alias(spans))
    joined = docs.join(found, F.col(doc_id).eqNullSafe(F.col(d)) & (hashed == F.col(h)), "left").drop(d, h)
    added = ["kept", "n_words", "n_removed"]
    passed = [f for f in docs.schema.fields if f.name.lower() not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            kept, words, removed = cut(batch.column(text), batch.column(spans), length)
            yield pa.record_batch([*(batch.column(f.name) for f in passed), kept, pa.array(words.astype(np.int64)), pa.array(removed.astype(np.int64))], names=[*(f.name for f in passed), *added])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in passed]
    return map_arrow(joined, run, ", ".join([*fields, "kept string, n_words long, n_removed long"]))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
