"""Constraints of stored tables: rows that break one go to a quarantine, and are counted while they are written.

One pass: each row gets the list of constraints that it breaks, the counts are observed metrics of the write, and no
further job is run for them. Constraints over rows (unique keys, references) are columns that a window or a join
adds before; of rows that share a unique key the first in the given order stays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from kinfold.functions import policy as P


@dataclass(frozen=True)
class Check:
    """A condition on a row; null counts as kept, as in SQL."""

    name: str
    condition: Column


@dataclass(frozen=True)
class Unique:
    """Of rows with equal ``keys`` (none null) the first by ``order`` stays."""

    name: str
    keys: tuple[str, ...]
    order: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    """``column`` must be among the values of ``target`` (a frame of one column) where it isn't null."""

    name: str
    column: str
    target: DataFrame


def judged(df: DataFrame, constraints: list) -> DataFrame:
    """``df`` with ``violations``, the names of the constraints that a row breaks, in their order."""
    broken = []
    for i, c in enumerate(constraints):
        at = f"_broken{i}"
        if isinstance(c, Check):
            df = df.withColumn(at, ~F.coalesce(c.condition, F.lit(True)))
        elif isinstance(c, Unique):
            whole = F.lit(True)
            for k in c.keys:
                whole = whole & F.col(k).isNotNull()
            # Rows without a whole key are dealt by a hash of all they hold: many of them are no hot key.
            spread = F.when(whole, F.lit(0)).otherwise(F.xxhash64(*[F.col(x) for x in c.order]))
            place = F.row_number().over(Window.partitionBy(*c.keys, spread).orderBy(*c.order))
            df = df.withColumn(at, whole & (place > 1))
        else:
            known = c.target.select(F.col(c.target.columns[0]).alias(f"_ref{i}")).distinct().withColumn(f"_is{i}", F.lit(True))
            df = df.join(known, F.col(c.column) == F.col(f"_ref{i}"), "left").withColumn(at, F.col(c.column).isNotNull() & F.col(f"_is{i}").isNull()).drop(f"_ref{i}", f"_is{i}")
        broken.append(F.when(F.col(at), F.lit(c.name)))
    names = [f"_broken{i}" for i in range(len(constraints))]
    return df.withColumn("violations", F.array_compact(F.array(*broken))).drop(*names)


def write_checked(df: DataFrame, constraints: list, path: str) -> dict[str, int]:
    """Write ``df`` in one job, kept rows under ``{path}/kept=true`` and quarantined ones under ``kept=false``.

    Returns the counts that were observed on the way: rows, kept, and one for each constraint.
    """
    metrics = Observation()
    counts = [F.count("*").alias("rows"), F.count_if(F.size("violations") == 0).alias("kept")]
    counts += [F.count_if(F.array_contains("violations", c.name)).alias(c.name) for c in constraints]
    checked = judged(df, constraints).observe(metrics, *counts).withColumn("kept", F.when(F.size("violations") == 0, "true").otherwise("false"))
    checked.write.mode("overwrite").partitionBy("kept").parquet(path)
    return dict(metrics.get)


def kept(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).where("kept = 'true'").drop("kept", "violations")


def quarantined(spark, path: str) -> DataFrame:
    """Rows that broke something, one for each broken constraint (``violation``)."""
    return spark.read.parquet(path).where("kept = 'false'").withColumn("violation", F.explode("violations")).drop("kept", "violations")


def raw_constraints() -> list:
    """Of records: a content once, and a row number once a source (a null number repeats as it likes)."""
    return [Unique("unique_content", ("content_hash",), ("ord",)), Unique("unique_source_row", ("source", "source_row_id"), ("ord", "content_hash"))]


def identity_constraints(candidates: DataFrame) -> list:
    """Of identities: known types and classes, an identifier once, an owner that exists, a confidence in range."""
    return [
        Check("known_type", F.col("itype").isin(*P.IDENTIFIER_STRENGTH)), Check("known_email_type", F.col("email_type").isin("work", "personal")), Unique("unique_identifier", ("itype", "match_key"), ("first_ord", "candidate_id")),
        Reference("owner_exists", "candidate_id", candidates.select("candidate_id")), Check("confidence_range", F.col("confidence").between(0, 1)),
    ]


def provenance_constraints(candidates: DataFrame) -> list:
    """Of field history (with ``current_field``, the field where the value is current): one current value a field, an owner that exists."""
    return [Unique("one_current_value", ("candidate_id", "current_field"), ("version",)), Reference("owner_exists", "candidate_id", candidates.select("candidate_id"))]


def change_constraints(candidates: DataFrame) -> list:
    """Of the change log: one decision a candidate, field, row and rule, an owner that exists."""
    return [Unique("one_decision", ("candidate_id", "field", "ord", "rule"), ("source", "new_value")), Reference("owner_exists", "candidate_id", candidates.select("candidate_id"))]
