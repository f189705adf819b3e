"""Running aggregates by key over ranges, so that a key with most of the rows is spread over as many tasks as it has ranges."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.storage import stage

#: How an aggregate over the rows behind and one over the own range become one; null is that of no rows.
_TOGETHER = {
    "max": F.greatest,
    "sum": lambda x, y: F.coalesce(x + y, x, y),
    "bit_xor": lambda x, y: F.coalesce(x.bitwiseXOR(y), x, y),
}


def earlier(df: DataFrame, by: str, order: str, running: dict[str, tuple[str, str]], *, ranges: int | None = None) -> DataFrame:
    """``df`` with aggregates over the rows of the same key that stand before, null at the first.

    ``running`` has for each new column an aggregate (max, sum or bit_xor) and the column it is of. Rows are dealt into
    ranges of (key, order) and each range runs over its own rows. A key that goes on in later ranges carries the aggregates
    of those behind it into them; that is a row for each range in which such a key goes on. Rows of one key and one order
    fall into one range; of those, which stands first is left open. A null key is a key like others.
    """
    key = (F.col(by), F.col(order))
    dealt = (df.repartitionByRange(*key) if ranges is None else df.repartitionByRange(ranges, *key)).withColumn("_range", F.spark_partition_id())
    dealt = stage(dealt, "ranges")
    of = {name: (getattr(F, how), column, _TOGETHER[how]) for name, (how, column) in running.items()}
    before = lambda *keys: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy(F.col(by).alias("_key"), F.col("_range").alias("_at")).agg(*[how(column).alias("_own_" + name) for name, (how, column, _) in of.items()])
    behind = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("_key", "_at", *[how("_own_" + name).over(behind).alias("_behind_" + name) for name, (how, *_) in of.items()])
    some = reduce(or_, (F.col("_behind_" + name).isNotNull() for name in of))
    carried = stage(carried.where(some), "carried")
    own = dealt.withColumns({name: how(column).over(before("_range", by)) for name, (how, column, _) in of.items()})
    joined = own.join(carried, (F.col("_range") == F.col("_at")) & F.col(by).eqNullSafe(F.col("_key")), "left")
    whole = joined.withColumns({name: together(F.col(name), F.col("_behind_" + name)) for name, (*_, together) in of.items()})
    return whole.drop("_range", "_at", "_key", *["_behind_" + name for name in of])


def earlier_maximum(df: DataFrame, by: str, order: str, value: str, *, ranges: int | None = None) -> DataFrame:
    """``df`` with ``earlier``: the maximum of ``value`` over the rows of the same key that stand before, null at the first."""
    return earlier(df, by, order, {"earlier": ("max", value)}, ranges=ranges)
