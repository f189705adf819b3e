"""The combination rule by fixed point: one block of very many rows, worked on by many tasks.

Row by row the rule reads: when a component's first row comes, it joins the only entity that has its four
values at that moment. What an entity has depends on who joined it before, so the rule is an order of steps. But every
answer depends on earlier rows only. So start from any guess of who joined whom (nobody did), derive
from it what each entity had when, and answer all first rows anew from that; then the answers
up to the first wrong guess are right, and so is that guess's. Repeated until nothing changes, all are right, and there is no
other such state. The rounds are as many as joins depend on one another, at most the number of first rows, and only what entities with a
changed member had is derived again.

What an entity had is a list of turns: taking on four values, giving them up. A first row's answer is a
running sum over the turns of its four values, and a running exclusive or of the entities in them is the one that is left if the sum is one.
Both run over ranges, so four values that most rows have are spread.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions import normalize as N
from kinfold.operators.fold import fold, history
from kinfold.operators.prefix import earlier, earlier_maximum
from kinfold.storage import stage

FOUR = ("name", "company", "city", "title")
_OBSERVED = ("value", "eq", "source", "time", "confidence", "rank")


def value_key(field: Column, value: Column) -> Column:
    """What the rule compares of a value of one of the four."""
    return F.when(field == "company", N.company_key(value)).when(field == "city", F.get_json_object(value, "$.city")).otherwise(F.lower(value))


def _four(known: Column) -> Column:
    return F.when(known, F.to_json(F.struct(*FOUR)))


def _turns(observed: DataFrame) -> DataFrame:
    """entity, position, four, step: after the row at that position an entity has (1) or no longer has (-1) four values."""
    by = ["entity", "field"]
    said = history(fold(observed.withColumnRenamed("position", "ord"), by), by)
    said = said.select("entity", F.col("observation.ord").alias("position"), "field", value_key(F.col("field"), F.col("observation.value")).alias("key"))
    # A struct tells a value that has become null from one that this row leaves.
    rows = said.groupBy("entity", "position").agg(*[F.max(F.when(F.col("field") == f, F.struct("key"))).alias(f) for f in FOUR])
    along = Window.partitionBy("entity").orderBy("position")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    now = rows.select("entity", "position", *[F.last(f, ignorenulls=True).over(so_far)["key"].alias(f) for f in FOUR])
    now = now.select("entity", "position", _four(reduce(and_, (F.col(f).isNotNull() for f in FOUR))).alias("now"))
    turned = now.withColumn("before", F.lag("now").over(along)).where(~F.col("now").eqNullSafe(F.col("before")))
    both = F.array(F.struct(F.col("before").alias("four"), F.lit(-1).alias("step")), F.struct(F.col("now").alias("four"), F.lit(1).alias("step")))
    return turned.select("entity", "position", F.explode(both).alias("t")).select("entity", "position", "t.*").where("four IS NOT NULL")


def _answers(asks: DataFrame, turns: DataFrame, ranges: int | None) -> DataFrame:
    """id, to: which entity each first row joins; its own if none or several have its four values."""
    at = lambda after: F.struct("position", F.lit(after).alias("after")).alias("at")
    turned = turns.select("four", at(1), "step", "entity", F.lit(None).cast("long").alias("id"))
    asked = asks.select("four", at(0), F.lit(0).alias("step"), F.lit(0).cast("long").alias("entity"), "id")
    told = earlier(turned.union(asked), "four", "at", {"n": ("sum", "step"), "who": ("bit_xor", "entity")}, ranges=ranges)
    return told.where("id IS NOT NULL").select("id", F.when(F.col("n") == 1, F.col("who")).otherwise(F.col("id")).alias("to"))


def combine(rows: DataFrame, observed: DataFrame, *, ranges: int | None = None) -> DataFrame:
    """content_hash, entity, combined, via for every row; an entity is named by its first row's component.

    ``rows``: content_hash, component, position (unique, in processing order) and what the row itself says of the four;
    ``observed``: content_hash, field (one of the four), value, eq, source, time, confidence, rank. ``via`` is
    the row that the entity had last when the rule attached one. A row that lacks one of the four, or has an empty one, joins nothing; an empty
    table gives no rows.
    """
    rows = stage(rows.select("content_hash", "component", "position", *FOUR), "combine-rows")
    first = F.min_by(F.struct("content_hash", "position", *FOUR), "position").alias("r")
    firsts = stage(rows.groupBy("component").agg(first).select(F.monotonically_increasing_id().alias("id"), "component", "r.*"), "first-rows")
    asks = stage(firsts.select("id", "position", _four(reduce(and_, (F.coalesce(F.col(f) != "", F.lit(False)) for f in FOUR))).alias("four")).where("four IS NOT NULL"), "asks")
    ids = firsts.select("component", "id")
    placed = stage(rows.join(ids, "component").select("content_hash", "id", "position"), "placed-rows")
    said = stage(observed.select("content_hash", "field", *_OBSERVED).join(placed, "content_hash").drop("content_hash"), "said")
    owners = firsts.select("id", F.col("id").alias("entity"))
    turns = stage(_turns(said.withColumn("entity", F.col("id")).drop("id")), "turns")
    some, near = asks, turns
    while True:
        told = _answers(some, near, ranges)
        moved = stage(told.join(owners, "id").where("to <> entity").select("id", "entity", "to"), "moved")
        if moved.isEmpty():
            break
        owners = stage(owners.join(moved.select("id", "to"), "id", "left").select("id", F.coalesce("to", "entity").alias("entity")), "owners")
        touched = stage(moved.select("entity").union(moved.select("to")).distinct(), "touched")
        members = stage(owners.join(touched, "entity", "left_semi"), "touched-members")
        fresh = stage(_turns(said.join(members, "id").drop("id")), "fresh-turns")
        changed = stage(turns.join(touched, "entity", "left_semi").select("four").union(fresh.select("four")).distinct(), "changed")
        turns = stage(turns.join(touched, "entity", "left_anti").union(fresh), "turns")
        some, near = (x.join(changed, "four", "left_semi") for x in (asks, turns))
    joined = owners.where("id <> entity")
    taken = stage(joined.join(firsts.select("id", "content_hash"), "id").select("content_hash", "entity"), "taken")
    owned = placed.join(owners, "id").select("content_hash", "position", "entity")
    several = stage(owned.join(taken.select("entity").distinct(), "entity", "left_semi").withColumn("row", F.struct("position", "content_hash")), "several")
    last = earlier_maximum(several, "entity", "position", "row", ranges=ranges).select("content_hash", F.col("earlier.content_hash").alias("via"))
    via = stage(taken.select("content_hash").join(last, "content_hash"), "via")
    named = owned.join(ids.withColumnRenamed("id", "entity").withColumnRenamed("component", "name"), "entity")
    return named.join(via.withColumn("combined", F.lit(True)), "content_hash", "left").select("content_hash", F.col("name").alias("entity"), F.coalesce("combined", F.lit(False)).alias("combined"), "via")
