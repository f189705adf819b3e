"""Which rows are one person: strong identifiers, then the guarded combination rule.

Rows that share an identifier are one entity, whatever the order they came in: connected components.
The combination rule depends on order and on the entity's values of the moment: a row without a
known identifier joins the only entity that has its name, company, city and title. Entities that a
combination could ever join form a block; only blocks with more than one component are folded: small ones row
by row, each in one group, larger ones by fixed point over many tasks (``combine``), with the same result.
Where the rows are few, they are one block.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions import normalize as N
from kinfold.operators.combine import FOUR as _FOUR
from kinfold.operators.combine import combine, value_key
from kinfold.operators.components import LOCAL_EDGES, connected_components
from kinfold.operators.fold import precedence
from kinfold.sources.crawl import observations
from kinfold.storage import stage
from kinfold.workers import ship

#: Rows of a block that one task folds; larger blocks are folded by fixed point.
BLOCK_ROWS = 20_000
#: Names of the fields that the combination rule compares.
_NAMES = {"full_name": "name", "current_company": "company", "location": "city", "current_title": "title"}


def strong_components(accepted: DataFrame) -> DataFrame:
    """content_hash, component for every accepted row."""
    edges = accepted.select(F.col("content_hash").alias("a"), F.explode("identifiers").alias("i")).select("a", F.concat(F.lit("~"), F.col("i.itype"), F.lit(":"), F.col("i.match_key")).alias("b"))
    return connected_components(edges).where(~F.col("node").startswith("~")).select(F.col("node").alias("content_hash"), "component")


def _signals(observed: DataFrame) -> DataFrame:
    """content_hash and the four values that the combination rule compares, null where the row has none."""
    pick = lambda field, value: F.max(F.when(F.col("field") == field, value))
    return observed.groupBy("content_hash").agg(
        F.lower(pick("full_name", F.col("value"))).alias("name"), N.company_key(pick("current_company", F.col("value"))).alias("company"), F.get_json_object(pick("location", F.col("value")), "$.city").alias("city"), F.lower(pick("current_title", F.col("value"))).alias("title")
    )


def blocks(members: DataFrame, signals: DataFrame) -> DataFrame:
    """component, block: components that a combination may join, by all four values of one row found among another's rows.

    Each distinct tuple of values looks up the components that have the rarest of its values, these are narrowed by the other
    three, and all that are left are linked to the tuple rather than to each other. So a name of very many components makes rows
    only where a tuple has no rarer value.
    """
    rows = members.join(signals, "content_hash").select("component", *_FOUR)
    values = stage(rows.select("component", F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in _FOUR])).alias("v")).select("component", "v.*").dropna().distinct(), "values")
    counts = values.groupBy("kind", "value").agg(F.count("*").alias("n"))
    tuples = stage(rows.dropna(subset=list(_FOUR)).select(*_FOUR).distinct(), "tuples")
    of = lambda c: counts.where(F.col("kind") == c).select(F.col("value").alias(c), F.col("n").alias("n_" + c))
    ranked = tuples
    for c in _FOUR:
        ranked = ranked.join(of(c), c)
    rarest = F.array_min(F.array(*[F.struct(F.col("n_" + c).alias("n"), F.lit(c).alias("kind"), F.col(c).alias("value")) for c in _FOUR]))
    sought = stage(ranked.withColumn("r", rarest).select(*_FOUR, F.col("r.kind").alias("kind"), F.col("r.value").alias("value")), "sought")
    found = sought.join(values, ["kind", "value"]).select(*_FOUR, "component")
    for c in _FOUR:
        found = found.join(values.where(F.col("kind") == c).select("component", F.col("value").alias(c)), ["component", c], "left_semi")
    found = stage(found.withColumn("tuple", F.concat(F.lit("~"), F.to_json(F.struct(*_FOUR)))).select("tuple", "component"), "holders")
    shared = found.groupBy("tuple").agg(F.count("*").alias("n")).where("n > 1").select("tuple")
    linked = connected_components(found.join(shared, "tuple").select(F.col("component").alias("a"), F.col("tuple").alias("b")))
    return linked.where(~F.col("node").startswith("~")).select(F.col("node").alias("component"), F.col("component").alias("block"))


def _fold_block(rows: pd.DataFrame) -> pd.DataFrame:
    """content_hash, entity, combined, via of the rows of one block; an entity is named by its first row's component.

    ``via`` is a row that the entity had when the combination rule attached one.
    """
    state: dict[str, dict[str, dict]] = {}
    owner: dict[str, str] = {}
    latest: dict[str, str] = {}
    holders: dict[tuple, set[str]] = defaultdict(set)  # entities by their four values of the moment
    four = lambda held: tuple(held[f]["key"] if f in held else None for f in _FOUR)
    out = []
    for row in rows.sort_values("position").to_dict("records"):
        combined, via, entity = False, None, owner.get(row["component"])
        seen = {f["field"]: f for f in ([] if row["observed"] is None else row["observed"])}
        if entity is None:
            mine = {f: row[f] for f in _FOUR}
            if all(mine.values()):
                hits = holders[tuple(mine.values())]
                if len(hits) == 1:
                    entity, combined = next(iter(hits)), True
                    via = latest[entity]
            entity = entity or row["component"]
            owner[row["component"]] = entity
        held = state.setdefault(entity, {})
        before = four(held)
        for f in _FOUR:
            new = seen.get(f)
            if new is not None and new["value"] is not None and (f not in held or (new["eq"] != held[f]["eq"] and precedence(held[f], new)[0])):
                held[f] = dict(new)
        if before != four(held):
            holders[before].discard(entity)
            holders[four(held)].add(entity)
        latest[entity] = row["content_hash"]
        out.append((row["content_hash"], entity, combined, via))
    return pd.DataFrame(out, columns=["content_hash", "entity", "combined", "via"])


def resolve(accepted: DataFrame, *, block_rows: int = BLOCK_ROWS, local: int = LOCAL_EDGES) -> DataFrame:
    """content_hash, entity, combined (the row was attached by the combination rule), via (to which row) for every accepted row.

    Blocks of more than ``block_rows`` rows are folded by fixed point; up to ``local`` rows are one block. Rows that say nothing of
    the four values belong to their component's entity.
    """
    ship(accepted.sparkSession)
    members = stage(strong_components(accepted), "strong")
    observed = observations(accepted)
    signals = stage(_signals(observed), "signals")
    # A counted, small number of rows is one block; any union of blocks gives the same.
    small = members.count() <= local
    block = members.select("component").distinct().withColumn("block", F.lit("all")) if small else stage(blocks(members, signals), "blocks")
    o = lambda c: F.col(f"ord.{c}")
    position = F.concat_ws("|", F.lpad(o("batch_seq").cast("string"), 9, "0"), o("crawled_at"), F.lpad(o("source_row_id").cast("string"), 12, "0"), o("content_hash"))
    inside = members.join(block, "component").join(accepted.select("content_hash", position.alias("position")), "content_hash").join(signals, "content_hash", "left")
    short = F.create_map(*[F.lit(x) for pair in _NAMES.items() for x in pair])[F.col("field")]
    said = observed.where(F.col("field").isin(*_NAMES)).withColumn("field", short)
    inside, said = stage(inside, "inside"), stage(said.select("content_hash", "field", "value", "eq", "source", "time", "confidence", "rank"), "said")
    large = stage(inside.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > block_rows).select("block"), "large")
    key = value_key(F.col("field"), F.col("value"))
    seen = said.groupBy("content_hash").agg(F.collect_list(F.struct("field", "value", "eq", "source", key.alias("key"), F.unix_micros("time").alias("time"), "confidence", "rank")).alias("observed"))
    rows = inside.join(large, "block", "left_anti").join(seen, "content_hash", "left").select("block", "content_hash", "component", "position", "observed", *_FOUR)
    folded = rows.groupBy("block").applyInPandas(lambda pdf: _fold_block(pdf.astype(object).where(pdf.notna(), None)), "content_hash string, entity string, combined boolean, via string")
    alone = members.join(block, "component", "left_anti").select("content_hash", F.col("component").alias("entity"), F.lit(False).alias("combined"), F.lit(None).cast("string").alias("via"))
    found = alone.union(folded)
    return found if large.isEmpty() else found.union(combine(inside.join(large, "block", "left_semi"), said))
