"""Staged tables last as long as anything that reads them."""

import os
import time

from kinfold.storage import shared_dir, stage, sweep


def _tables(spark, name):
    folder = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    return [x for x in os.listdir(folder) if x.startswith(f"kinfold-{name}-")]


def _swept(spark, name):
    """Sweep until the tables are gone: the JVM lets plans that have run go with some delay."""
    for _ in range(20):
        sweep(spark)
        if not _tables(spark, name):
            return True
        time.sleep(0.2)
    return False


def test_sweep(spark):
    name = f"swept{time.time_ns()}"
    df = stage(spark.range(100), name)
    kept = df.where("id > 5").groupBy((df.id % 3).alias("k")).count()
    sweep(spark)
    assert len(_tables(spark, name)) == 1
    del df
    sweep(spark)
    assert len(_tables(spark, name)) == 1 and kept.count() == 3  # a derived frame keeps its table
    del kept
    assert _swept(spark, name)


def test_sweep_keeps_cached_frames(spark):
    cached = stage(spark.range(10), "cached").selectExpr("id + 1 AS x").cache()
    sweep(spark)
    assert cached.count() == 10
    cached.unpersist()
