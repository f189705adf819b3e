"""The field fold: many observations of a field become one value, with history, changes and conflicts.

Observations of an (entity, field) are taken in processing order. A later observation replaces the
current one if its source is more trusted for the field; with equal trust if it is newer; with equal
time if it is more confident. An equal value leaves the current observation as it is, its source
and time included, which is why the fold is ordered and isn't a maximum. A null never deletes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kinfold.functions import policy as P
from kinfold.workers import map_arrow

_FIELDS = ("ord", "value", "eq", "source", "time", "confidence", "rank")
_REFUSED = "REJECTED:null_from_source_is_not_deletion"


def trust_rank(field: Column, source: Column) -> Column:
    pairs = {f"{f}|{s}": r for f, by in P.TRUST.items() for s, r in by.items()}
    return F.coalesce(F.create_map(*map(F.lit, chain.from_iterable(pairs.items())))[F.concat_ws("|", field, source)], F.lit(P.DEFAULT_TRUST))


def precedence(cur: dict, new: dict) -> tuple[bool, str]:
    """Whether new replaces cur, and by which rule. A null rank or time decides nothing, a null confidence is 0."""

    def differ(f: str) -> bool:
        return cur[f] is not None and new[f] is not None and cur[f] != new[f]

    if differ("rank"):
        return new["rank"] < cur["rank"], "source_trust"
    if differ("time"):
        later = new["time"] > cur["time"]
        return later, "newer_observation_same_source" if later and new["source"] == cur["source"] else "recency"
    surer = (new["confidence"] or 0.0) > (cur["confidence"] or 0.0)
    return surer, "confidence" if surer else "incumbent_kept"


def _steps(rows: Iterator[dict], by: list[str]) -> Iterator[dict]:
    """The steps of rows that are sorted by key and order: held in memory are the current observation and its step.

    The step that made the current observation is given out when it is known what supersedes it.
    """
    key = cur = held = None
    for row in rows:
        now = {c: row[c] for c in by}
        if now != key:
            if held is not None:
                yield held | {"is_current": True}
            key, cur, held, version = now, None, None, 0
        new = {f: row[f] for f in _FIELDS}
        step = now | {"ord": new["ord"], "applied": False, "conflict": False, "old": cur, "new": new, "winner": None, "loser": None, "version": None, "superseded_by": None, "is_current": False}
        if new["value"] is None:
            if cur is not None and row["guard"]:
                yield step | {"rule": _REFUSED}
            continue
        if cur is None:
            wins, step["rule"] = True, "fill_value"
        elif cur["eq"] is None or new["eq"] is None or cur["eq"] == new["eq"]:
            continue
        else:
            wins, step["rule"] = precedence(cur, new)
            best, worst = (new, cur) if wins else (cur, new)
            step |= {"conflict": True, "winner": best["source"], "loser": worst["source"]}
        if not wins:
            yield step
            continue
        if held is not None:
            yield held | {"superseded_by": step["rule"]}
        cur, held, version = new, step | {"applied": True, "version": version}, version + 1
    if held is not None:
        yield held | {"is_current": True}


def fold(observations: DataFrame, by: list[str], *, protected: Column | None = None) -> DataFrame:
    """One row for each event of a key in ``by``: ord, rule, applied, conflict, old, new, winner, loser.

    ``observations``: the key columns, ord (any orderable type), value, eq (what equality looks at),
    source, time, confidence and rank; old and new are structs of these. A refused null is an event where ``protected``
    is true. Applied events are numbered by version, name the rule that superseded them, and is_current marks the last.

    A key's observations are sorted, on disk where they are many, and pass one after the other through one task, which holds the
    current one only: a key with most of the rows takes one task's time but no more memory than others.
    """
    guard = F.lit(True) if protected is None else protected
    micros = F.unix_micros(F.col("time").cast("timestamp"))
    flat = observations.select(*by, "ord", F.col("value").cast("string").alias("value"), F.col("eq").cast("string").alias("eq"), F.col("source").cast("string").alias("source"), micros.alias("time"), F.col("confidence").cast("double").alias("confidence"), F.col("rank").cast("int").alias("rank"), guard.alias("guard"))
    keys = StructType([flat.schema[c] for c in by])
    one = StructType([flat.schema[f] for f in _FIELDS])
    schema = StructType([*keys.fields, flat.schema["ord"]]).add("rule", "string").add("applied", "boolean").add("conflict", "boolean").add("old", one).add("new", one)
    for name, kind in {"winner": "string", "loser": "string", "version": "integer", "superseded_by": "string", "is_current": "boolean"}.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, out = to_arrow_schema(schema), []
        for step in _steps((row for batch in batches for row in batch.to_pylist()), by):
            out.append(step)
            if len(out) == 5000:
                yield pa.RecordBatch.from_pylist(out, kind)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, kind)

    def timed(c: str) -> Column:
        parts = [F.timestamp_micros(F.col(c)["time"]).alias("time") if f == "time" else F.col(c)[f].alias(f) for f in _FIELDS]
        return F.when(F.col(c).isNotNull(), F.struct(*parts))

    dealt = flat.repartition(*by).sortWithinPartitions(*by, *_FIELDS)
    return map_arrow(dealt, run, schema).withColumns({"old": timed("old"), "new": timed("new")})


def current(folded: DataFrame, by: list[str]) -> DataFrame:
    """The winning observation of each key that has one."""
    return folded.where("is_current").select(*by, F.col("new").alias("current"))


def history(folded: DataFrame, by: list[str]) -> DataFrame:
    """Every value that was ever current, with the rule that superseded it (null for the current one)."""
    return folded.where("applied").select(*by, "version", F.col("new").alias("observation"), "rule", "superseded_by", "is_current")


def changes(folded: DataFrame, by: list[str]) -> DataFrame:
    """The change log: applied changes and refused deletions."""
    return folded.where(F.col("applied") | (F.col("rule") == _REFUSED)).select(*by, "ord", "rule", "applied", "conflict", "old", "new", "winner", "loser")


def conflicts(folded: DataFrame, by: list[str]) -> DataFrame:
    return folded.where("conflict").select(*by, "ord", "rule", "applied", "conflict", "old", "new", "winner", "loser")
