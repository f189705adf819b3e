"""A training corpus from ``documents``: quality rules, line dedup, near dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; the caller
writes its result as Parquet and hands the reread rows to the next. All but the last return the
columns of ``documents``, with n_chars counted anew where the text has changed. Documents left
without words by a stage go with it.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm import alike, lines, packing, quality, simhash, substring
from kinfold.operators.components import connected_components
from kinfold.storage import shared_dir, stage, sweep, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, n_chars counted, rows without words dropped."""
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.where(packing.n_words(F.col("text")) > 0).select(*COLUMNS)


def _stage(step):
    """A stage of the chain; what earlier stages staged goes first, so far as nobody can read it any more."""

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        sweep(spark)
        return step(spark, docs, sf_dir)

    return run


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    cutoffs = quality.certified_cutoffs(docs, labels)
    return quality.judge(docs, cutoffs).where("kept").select(*COLUMNS)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal and nearly equal lines the first stays; of short lines, of equal ones only."""
    return _documents(lines.dedup_lines(docs, short=True))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one row stays: that with the smallest id, a null id being last, then the smallest text hash.

    Near copies: SimHashes of 5-word shingles within two bits, or sets of 5-word shingles alike at 0.8 or more.
    """
    # Classes are of texts, not of ids: several texts may share an id, or have none.
    h = F.xxhash64("text")
    texts = docs.select(h.alias("h"), "text")
    bits = stage(simhash.near_duplicates(texts, "h", shingle=alike.SHINGLE).select("doc_id", "component_id").distinct(), "bits")
    near = bits.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")).union(alike.links(texts))
    nodes = connected_components(near).toDF("_node", "_class")
    classes = bits.join(nodes, F.col("doc_id") == F.col("_node"), "left").select(F.col("doc_id").alias("_text"), F.coalesce("_class", "doc_id").alias("_class"))
    rows = docs.groupBy("doc_id", h.alias("_h")).agg(F.count("*").alias("_n"))
    least = rows.groupBy("_h").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_h", "_n")).alias("p"))
    keep = least.join(classes, F.col("_h") == F.col("_text")).groupBy("_class").agg(F.min("p").alias("p"))
    keep = stage(keep.select(F.col("p.doc_id").alias("_id"), F.col("p._h").alias("_kept"), F.col("p._n").alias("_n")), "kept-texts")
    out = docs.join(keep, F.col("doc_id").eqNullSafe(F.col("_id")) & (h == F.col("_kept")))
    once = out.where("_n = 1").select(*COLUMNS)
    return once.union(out.where("_n > 1").dropDuplicates(["doc_id", "_kept"]).select(*COLUMNS))


@_stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside passages that repeat go; texts without such passages stay as they are."""
    found = substring.remove_repeats(docs)
    return _documents(found.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences in length buckets and token-budget batches."""
    return packing.pack(docs, packing.n_words(F.col("text")))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", pack),
]

#: Thresholds with exact tails, edit classes and the optimal buckets are beyond one SQL statement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what lies between them is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for k, (_, step) in enumerate(STAGES[:-1]):
        step(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = written(spark, f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
