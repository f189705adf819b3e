"""Budgeted enrichment: rank who may be looked up, spend what is left of the budget, pay once a key.

The cache is state: it records money spent. A key in the cache is never billed again, found or not
(``expire`` turns misses loose after their time to live, for callers who want that).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions import policy as P
from kinfold.storage import stage


def rank_eligible(eligible: DataFrame, key: str, score: str) -> DataFrame:
    """``eligible`` with ``position`` (from 1) by score (highest first), then key.

    Rows are dealt into ranges of that order, which split a score that most rows have; a row's position is its place
    in its range behind the counts of the ranges before.
    """
    ranges = stage(eligible.repartitionByRange(F.col(score).desc(), key).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = Window.partitionBy("_range").orderBy(F.col(score).desc(), key)
    return ranges.withColumn("_r", F.row_number().over(inside)).join(F.broadcast(before), "_range").withColumn("position", F.col("_before") + F.col("_r")).drop("_range", "_before", "_r")


def best_within(uncached: DataFrame, spent: int, key: str, score: str, budget: int = P.LOOKUP_BUDGET) -> DataFrame:
    """The best of ``uncached`` that the remaining budget pays for."""
    return uncached.orderBy(F.col(score).desc(), key).limit(max(budget - spent, 0))


def split_cache(eligible: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(not in the cache, in the cache)."""
    return eligible.join(cache.select(key), key, "left_anti"), eligible.join(cache.select(key).distinct(), key, "left_semi")


def select_within(uncached: DataFrame, spent: int, key: str, score: str, budget: int = P.LOOKUP_BUDGET) -> DataFrame:
    """``uncached`` with position and ``selected``: the best that the remaining budget pays for."""
    return rank_eligible(uncached, key, score).withColumn("selected", F.col("position") <= max(budget - spent, 0))


def bill(selected: DataFrame, provider: DataFrame, key: str, now: Column) -> DataFrame:
    """Cache rows for the selected keys that the provider knows; an unknown key uses a slot but isn't billed."""
    fetched = selected.join(provider, key)
    ttl = F.when(F.col("status") == "found", F.lit("2099-01-01").cast("timestamp")).otherwise(expires(now))
    return fetched.withColumns({"cost": F.lit(P.LOOKUP_COST).cast("decimal(6,2)"), "fetched_at": now, "ttl_expires_at": ttl})


def expires(fetched_at: Column, days: int = P.NEGATIVE_TTL_DAYS) -> Column:
    return fetched_at + F.make_dt_interval(F.lit(days))


def expire(cache: DataFrame, now: Column) -> DataFrame:
    """The cache without misses that are past their time to live."""
    return cache.where((F.col("status") == "found") | (F.col("ttl_expires_at") > now))
