"""Substring search through an index of character n-grams.

The index has a row for each distinct n-gram of each record's lower-cased field. A pattern's fixed parts (``%`` and
``_`` are wildcards) give n-grams, all of which a record must have; the records that do are looked up and verified by the pattern itself.
A pattern whose parts are all shorter than n has no n-gram to go by and scans the field alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.storage import stage

N = 3
#: n-grams of a pattern that are looked up, the first of all positions; the rest is left to the verification.
LOOKED_UP = 8


def grams(text: Column, n: int = N) -> Column:
    """The distinct n-grams of a text in lower case."""
    low = F.lower(text)
    starts = F.when(F.length(low) >= n, F.sequence(F.lit(1), F.length(low) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(low, i, F.lit(n))))


def postings(records: DataFrame, key: str, fields: list[str], n: int = N) -> DataFrame:
    """gram, field and the key of every record that has the gram in the field."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), grams(F.col(f).cast("string"), n).alias("grams")) for f in fields]))
    return records.select(key, each.alias("x")).select(key, "x.field", F.explode("x.grams").alias("gram"))


def write_postings(records: DataFrame, key: str, fields: list[str], path: str, n: int = N) -> None:
    """The index as files in which a gram's records lie together, so that a look-up reads few row groups."""
    rows = postings(records, key, fields, n)
    # A gram of very many records may spread over several ranges.
    rows.repartitionByRange("gram", "field", key).sortWithinPartitions("gram", "field", key).write.mode("overwrite").parquet(path)


def pattern_grams(pattern: str, n: int = N) -> list[str]:
    """The n-grams of the fixed parts of a pattern, spread over it where there are more than LOOKED_UP."""
    parts, now, i = [], "", 0
    while i < len(pattern):
        if pattern[i] == "\\" and i + 1 < len(pattern):
            now, i = now + pattern[i + 1], i + 1
        elif pattern[i] in "%_":
            parts, now = [*parts, now], ""
        else:
            now += pattern[i]
        i += 1
    found = list(dict.fromkeys(p.lower()[k : k + n] for p in [*parts, now] for k in range(len(p.lower()) - n + 1)))
    step = max(1, len(found) // LOOKED_UP)
    return found[::step][:LOOKED_UP]


def matching(index: DataFrame, key: str, field: str, pattern: str, n: int = N) -> DataFrame | None:
    """The keys of records that have all n-grams of the pattern in the field; None where it has none."""
    wanted = pattern_grams(pattern, n)
    if not wanted:
        return None
    rows = index.where((F.col("field") == field) & F.col("gram").isin(wanted))
    return rows.groupBy(key).agg(F.count_distinct("gram").alias("_n")).where(F.col("_n") == len(wanted)).select(key)


def like(records: DataFrame, index: DataFrame, key: str, fields: list[str], pattern: str, *, other: Column | None = None, n: int = N) -> DataFrame:
    """Records with ``pattern`` as a substring of one of the fields, case-insensitive, or for which ``other`` holds.

    The same as a scan by ``ilike``; with the index, records are joined to the keys found in it. ``other`` is a condition
    that the index doesn't know, so it is taken from a scan of its own columns.
    """
    verified = reduce(lambda a, b: a | b, [F.coalesce(F.col(f).ilike(f"%{pattern}%"), F.lit(False)) for f in fields])
    keys = [matching(index, key, f, pattern, n) for f in fields]
    if any(k is None for k in keys):
        return records.where(verified if other is None else verified | F.coalesce(other, F.lit(False)))
    if other is not None:
        keys.append(records.where(other).select(key))
        verified = verified | F.coalesce(other, F.lit(False))
    found = stage(reduce(lambda a, b: a.union(b), keys).distinct(), "found")
    return records.join(found, key, "left_semi").where(verified)
