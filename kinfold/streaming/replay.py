"""Replays and late batches as a stream: each micro-batch joins the stored rows, and state is derived anew.

Nothing is dropped as late. A row's content hash decides whether it has been seen, in this run or an
earlier one, so a replayed file or batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kinfold.storage import stage
from kinfold.streaming.archive import Archive


def append_new(rows: DataFrame, stored_path: str, key: str = "content_hash") -> DataFrame:
    """Append to the stored table those rows whose key it lacks, once each; return what was new.

    One writer at a time: two that append at once may both store a row that is new to both. Every append reads the keys of
    all that is stored; ``archive.Archive`` has a table that isn't read whole.
    """
    spark = rows.sparkSession
    fresh = rows.dropDuplicates([key])
    try:
        stored = spark.read.parquet(stored_path)
    except Exception as error:  # no table yet
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
    else:
        fresh = fresh.join(stored.select(key), key, "left_anti")
    fresh = stage(fresh.select(*rows.columns), "fresh")  # else what is returned would be looked up again after the append
    fresh.write.mode("append").parquet(stored_path)
    return fresh


def ingest_stream(stream: DataFrame, stored: Archive | str, checkpoint: str, then: Callable[[int], None] | None = None) -> StreamingQuery:
    """Run all that is available into an archive, or a folder through ``append_new``; ``then`` is called after each micro-batch."""

    def one(batch: DataFrame, number: int) -> None:
        stored.append(batch) if isinstance(stored, Archive) else append_new(batch, stored)
        if then is not None:
            then(number)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
