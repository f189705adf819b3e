"""Packing: length buckets with the least padding, and token-budget batches inside them.

Documents longer than ``max_tokens`` are cut into sequences of that length, the rest last. The
histogram of sequence lengths over the whole table (at most ``max_tokens + 1`` rows) goes to the
driver, where dynamic programming finds the boundaries of ``buckets`` buckets that minimise the
total padding; a sequence is padded to the boundary of its bucket. Inside a bucket, sequences are
numbered without gaps and ``token_budget // boundary`` consecutive ones form a batch.

The numbering is a prefix sum of counts by (bucket, slice) plus a row number inside the slice, so
that a bucket with most of the rows is spread over as many tasks as it has slices.

Defined results: null and empty texts are sequences of length 0, padded to the smallest boundary; repeated
rows are packed each; ties in length share a bucket; an empty table gives no rows; other columns
are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.text import WORD
from kinfold.storage import stage

MAX_TOKENS = 4096
BUCKETS = 16
TOKEN_BUDGET = 65_536
#: Sequences that one slice of the numbering holds on average.
SLICE = 4096


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Boundaries (the largest is the longest length) that minimise sum(count * (boundary - length))."""
    order = np.argsort(lengths)
    lengths, counts = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    n = len(lengths)
    if n <= buckets:
        return lengths.tolist()
    rows = np.concatenate(([0], np.cumsum(counts)))
    tokens = np.concatenate(([0], np.cumsum(counts * lengths)))
    far = np.iinfo(np.int64).max // 4
    best = np.full(n + 1, far)
    best[0] = 0
    back = np.zeros((buckets + 1, n + 1), np.int32)
    for b in range(1, buckets + 1):
        step = np.full(n + 1, far)
        for a in range(1, n + 1, 256):
            j = np.arange(a, min(a + 256, n + 1))
            i = np.arange(j[-1])
            cost = best[i][None, :] + lengths[j - 1][:, None] * (rows[j][:, None] - rows[i][None, :]) - (tokens[j][:, None] - tokens[i][None, :])
            cost[i[None, :] >= j[:, None]] = far
            back[b, j] = cost.argmin(axis=1)
            step[j] = cost.min(axis=1)
        best = step
    out, j = [], n
    for b in range(buckets, 0, -1):
        out.append(int(lengths[j - 1]))
        j = int(back[b, j])
    return out[::-1]


def pack(docs: DataFrame, length: Column, *, doc_id: str = "doc_id", max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """doc_id, chunk, start, n_tokens, boundary, batch, slot, padding of every sequence; (boundary, batch) names a batch."""
    # Lengths are written once: the histogram, the offsets and the numbering each read them.
    sized = stage(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(length, F.lit(0)).cast("long").alias("_n"), F.monotonically_increasing_id().alias("_row")), "lengths")
    chunks = F.greatest(F.ceil(F.col("_n") / max_tokens), F.lit(1)).cast("long")
    rows = sized.select("doc_id", "_n", "_row", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"))
    rows = rows.select("doc_id", "_row", "chunk", (F.col("chunk") * max_tokens).alias("start"), F.least(F.lit(max_tokens), F.col("_n") - F.col("chunk") * max_tokens).alias("n_tokens"))
    histogram = rows.groupBy("n_tokens").agg(F.count("*").alias("c")).collect()
    edges = boundaries(np.array([r[0] for r in histogram]), np.array([r[1] for r in histogram]), buckets) if histogram else [0]
    slices = max(1, sum(r[1] for r in histogram) // SLICE)
    # Rows of one id (or none) and length are dealt onto slices too, by a number that each has in its written part.
    salt = F.when(F.col("doc_id").isNull(), F.col("_row")).otherwise(F.lit(0))
    boundary = F.element_at(F.filter(F.array(*map(F.lit, edges)), lambda e: e >= F.col("n_tokens")), 1).cast("long")
    rows = rows.withColumn("boundary", boundary).withColumn("slice", F.pmod(F.xxhash64("doc_id", "chunk", "n_tokens", salt), F.lit(slices)))
    before = Window.partitionBy("boundary").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("boundary", "slice").agg(F.count("*").alias("c")).withColumn("offset", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    inside = Window.partitionBy("boundary", "slice").orderBy("doc_id", "chunk")
    numbered = rows.withColumn("r", F.row_number().over(inside) - 1).join(offsets, ["boundary", "slice"]).withColumn("r", F.col("r") + F.col("offset"))
    size = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest(F.col("boundary"), F.lit(1))))
    return numbered.select(
        "doc_id", "chunk", "start", "n_tokens", "boundary", F.floor(F.col("r") / size).cast("long").alias("batch"), F.pmod(F.col("r"), size).cast("long").alias("slot"), (F.col("boundary") - F.col("n_tokens")).alias("padding")
    )


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), n_words(F.col("text")))
