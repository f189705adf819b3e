"""The archive of all rows ever seen: a table in buckets of the content hash, which takes a content once.

New rows are dealt into the table's buckets and compared bucket by bucket, so that what is stored is neither shuffled
nor sorted, however large it is; a Bloom filter a file lets Parquet skip those that lack a hash. A content keeps the id of
its first insert.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions import normalize as N
from kinfold.storage import stage

BUCKETS = 64


class Archive:
    """A bucketed table of the session's catalogue; ``path`` is where its files go (the warehouse, unless given).

    One writer at a time: two that append at once may both store a content that is new to both.
    """

    def __init__(self, spark, name: str, *, key: str = "content_hash", buckets: int = BUCKETS, path: str | None = None):
        self.spark, self.name, self.key, self.buckets, self.path = spark, name, key, buckets, path

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Rows whose key the archive lacks, one for each key."""
        # Dealt as the table is: of the two sides of the anti join only the new rows move.
        fresh = rows.where(F.col(self.key).isNotNull()).repartition(self.buckets, self.key).dropDuplicates([self.key])
        if not self.exists():
            return fresh
        return fresh.join(self.table().select(self.key).hint("merge"), self.key, "left_anti").select(*rows.columns)

    def append(self, rows: DataFrame) -> DataFrame:
        """Store what is new and return it; what is returned is read from its own file and never looked up again."""
        fresh = stage(self.unseen(rows), "archived")
        writer = fresh.repartition(self.buckets, self.key).write.mode("append").bucketBy(self.buckets, self.key).sortBy(self.key).option(f"parquet.bloom.filter.enabled#{self.key}", "true")
        (writer.option("path", self.path) if self.path else writer).saveAsTable(self.name)
        return fresh


def archive_responses(archive: Archive, responses: DataFrame) -> DataFrame:
    """Look-up responses with ``response_id``, stored once: an equal response gets the id that it had before.

    The id is derived from the content (keys sorted), so that insert and get are one step.
    """
    payload = F.to_json(F.struct(*sorted(responses.columns)))
    named = responses.withColumn("content_hash", F.sha2(payload, 256)).withColumn("response_id", N.deterministic_id("resp_", F.col("content_hash")))
    archive.append(named)
    return named
