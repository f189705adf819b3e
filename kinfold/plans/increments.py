"""Batches into a stored state: what a batch touches is derived anew, everything else stays as it is stored.

A batch touches the people that hold an identifier or bear a name of its rows, and so on along their own identifiers and
names. No rule reaches beyond that: rows are matched by identifiers, the combination rule and the refusals ask for equal
names. The touched people's rows, old and new, are derived by the same code as a whole build (``people.derive``).

The state is a folder of tables cut into buckets by a hash of their key. A step reads the buckets of the keys that it looks
for and no others, and writes touched buckets as new files. A manifest, written last, names the files of each version, so
a step that fails changes nothing and readers of an older version keep theirs.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kinfold.operators.fold import conflicts, history
from kinfold.plans.people import People, derive
from kinfold.sources.crawl import mail_identifier, phone_identifier, read_batches, records
from kinfold.storage import stage

BUCKETS = 64
#: The tables of people by candidate; the others are indexes.
BY_CANDIDATE = ("rows", "candidates", "identities", "change_log", "merged", "folded", "declined")
KEY = {**{t: "candidate_id" for t in BY_CANDIDATE}, "records": "content_hash", "keys": "key", "names": "name", "cached": "lookup_key"}


@dataclass
class State:
    """A version of the stored tables. ``files``: by table its schema and, by bucket, its folder."""

    path: str
    buckets: int
    version: int = 0
    batches: list[str] = field(default_factory=list)
    schemas: dict[str, str] = field(default_factory=dict)
    files: dict[str, dict[str, str]] = field(default_factory=dict)


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def load(spark: SparkSession, path: str, version: int | None = None, *, buckets: int = BUCKETS) -> State:
    """The latest version of the state in a folder, or an earlier one; an empty state where there is none."""
    fs, target = _folder(spark, f"{path}/manifests")
    found = sorted(int(x.getPath().getName().removesuffix(".json")) for x in fs.listStatus(target)) if fs.exists(target) else []
    if version is None:
        version = found[-1] if found else 0
    if version == 0:
        return State(path, buckets)
    text = spark.read.text(f"{path}/manifests/{version}.json", wholetext=True).first().value
    return State(path, **json.loads(text))


def _save(spark: SparkSession, state: State) -> None:
    """Write the manifest under its final name in one step; a version that another writer took first raises."""
    fs, target = _folder(spark, f"{state.path}/manifests/{state.version}.json")
    out = fs.create(target, False)
    try:
        out.write(bytearray(json.dumps({k: v for k, v in vars(state).items() if k != "path"}).encode()))
    finally:
        out.close()


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _numbers(keys: DataFrame, buckets: int) -> list[int]:
    """The buckets of a frame's first column: at most ``buckets`` numbers."""
    return sorted(r[0] for r in keys.select(bucket_of(F.col(keys.columns[0]), buckets)).distinct().collect())


def read(spark: SparkSession, state: State, table: str, numbers: list[int] | None = None) -> DataFrame | None:
    """A table, or some of its buckets; None before it was first written."""
    if table not in state.schemas:
        return None
    schema = StructType.fromJson(json.loads(state.schemas[table]))
    paths = [p for b, p in state.files[table].items() if numbers is None or int(b) in set(numbers)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def _of(spark: SparkSession, state: State, table: str, keys: DataFrame) -> DataFrame | None:
    """The rows of a table whose key is among ``keys`` (one column of the key's name), out of those keys' buckets."""
    found = read(spark, state, table, _numbers(keys, state.buckets))
    return None if found is None else found.join(keys, KEY[table], "left_semi")


def _replaced(spark: SparkSession, old: State, new: State, table: str, gone: DataFrame | None, fresh: DataFrame, numbers: list[int]) -> None:
    """These buckets, which are those of ``gone`` and ``fresh``, without the rows of candidates ``gone`` and with ``fresh``, as files of the new version."""
    key = KEY[table]
    kept = read(spark, old, table, numbers)
    if kept is not None and gone is not None:
        kept = kept.join(gone, "candidate_id", "left_anti")
    rows = fresh if kept is None else kept.unionByName(fresh)
    folder = f"{new.path}/{table}/{new.version}-{uuid.uuid4().hex[:8]}"
    # Small buckets share a task, a large one is split over several.
    rows.withColumn("bucket", bucket_of(F.col(key), new.buckets)).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
    new.schemas[table] = rows.schema.json()
    fs, target = _folder(spark, folder)
    written = {x.getPath().getName().removeprefix("bucket=") for x in fs.listStatus(target) if x.getPath().getName().startswith("bucket=")}
    files = {b: p for b, p in old.files.get(table, {}).items() if int(b) not in set(numbers)}
    new.files[table] = files | {b: f"{folder}/bucket={b}" for b in written}


def _keys_of(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("identifiers").alias("i")).select(F.concat("i.itype", F.lit(":"), "i.match_key").alias("key")).distinct()


def _names_of(rows: DataFrame, *others: str) -> DataFrame:
    """The names that rows bear, as the combination rule and the refusals compare them."""
    name = F.lower(F.filter("fields", lambda f: f["field"] == "full_name")[0]["value"])
    return rows.where(F.exists("fields", lambda f: f["field"] == "full_name")).select(name.alias("name"), *others).where("name IS NOT NULL").distinct()


def _touched(spark: SparkSession, state: State, fresh: DataFrame, cache: DataFrame | None, looked_up: DataFrame | None) -> DataFrame:
    """candidate_id of the stored people that new rows or new look-ups reach, along identifiers and names."""
    keys, names, touched, count = stage(_keys_of(fresh), "keys"), stage(_names_of(fresh), "names"), None, -1
    while True:
        found = [f.select("candidate_id") for f in (_of(spark, state, "keys", keys), _of(spark, state, "names", names)) if f is not None]
        if looked_up is not None:
            found.append(looked_up.select("candidate_id"))
        if not found:
            return spark.createDataFrame([], "candidate_id string")
        every = found[0]
        for f in found[1:]:
            every = every.union(f)
        touched = stage(every.distinct(), "touched")
        if (now := touched.count()) == count or now == 0:
            return touched
        count = now
        rows = _of(spark, state, "rows", touched)
        if rows is None:
            return touched
        rows = stage(rows, "touched-rows")
        more = _keys_of(rows)
        if cache is not None:
            given = cache.join(touched, "candidate_id", "left_semi").select(F.explode(F.array_compact(F.array(mail_identifier(F.col("work_email")), mail_identifier(F.col("personal_email")), phone_identifier(F.col("mobile"))))).alias("i"))
            more = more.union(given.select(F.concat("i.itype", F.lit(":"), "i.match_key").alias("key")))
        keys, names = stage(_keys_of(fresh).union(more).distinct(), "keys"), stage(_names_of(fresh).union(_names_of(rows)).distinct(), "names")


def extend(spark: SparkSession, state: State, batches: list[tuple[str, str]], cache: DataFrame | None = None) -> State:
    """The state with these batches (and what ``look_up`` returned so far) merged in; the same as a build of all batches."""
    rec = records(read_batches(spark, batches)) if batches else None
    first = len(state.batches)
    new = State(state.path, state.buckets, state.version + 1, [*state.batches, *[b for b, _ in batches]], dict(state.schemas), {t: dict(f) for t, f in state.files.items()})
    if rec is not None:
        rec = rec.withColumns({"batch_seq": F.col("batch_seq") + first, "ord": F.struct((F.col("ord.batch_seq") + first).alias("batch_seq"), "ord.crawled_at", "ord.source_row_id", "ord.content_hash")})
        rec = stage(rec, "records")
        seen = _of(spark, state, "records", rec.select("content_hash"))
        if seen is not None:
            rec = stage(rec.join(seen.select("content_hash"), "content_hash", "left_anti"), "records")
    looked_up = None
    if cache is not None:
        known = _of(spark, state, "cached", cache.select("lookup_key").distinct())
        looked_up = stage(cache if known is None else cache.join(known, "lookup_key", "left_anti"), "looked-up")
        if looked_up.isEmpty():
            looked_up = None
    if (rec is None or rec.isEmpty()) and looked_up is None:
        _save(spark, new)
        return new
    if rec is None:
        rec = read(spark, state, "records").limit(0)
    fresh = rec.where("reason IS NULL")
    if cache is not None and "merged" in state.schemas:
        later = read(spark, state, "merged").select(F.col("loser").alias("candidate_id"), F.col("candidate_id").alias("_now"))
        remap = lambda c: c.join(later, "candidate_id", "left").withColumn("candidate_id", F.coalesce("_now", "candidate_id")).drop("_now")
        cache, looked_up = remap(cache), None if looked_up is None else remap(looked_up)
    touched = _touched(spark, state, fresh, cache, looked_up)
    stored = _of(spark, state, "rows", touched)
    rows = fresh if stored is None else stored.select(*fresh.columns).union(fresh)
    mine = None
    if cache is not None:
        mine = cache.join(touched, "candidate_id", "left_semi")
    part = derive(rec, stage(rows, "part"), mine)
    at = _numbers(touched.union(part.rows.select("candidate_id")), state.buckets)
    for t in BY_CANDIDATE:
        _replaced(spark, state, new, t, touched, getattr(part, t), at)
    held = part.identities.select(F.concat("itype", F.lit(":"), "match_key").alias("key"), "candidate_id")
    named = _names_of(part.rows, "candidate_id")
    for t, index in (("keys", held), ("names", named)):
        _replaced(spark, state, new, t, touched, index, _numbers(_index_of(spark, state, t, stored).union(index.select(KEY[t])), state.buckets))
    _replaced(spark, state, new, "records", None, rec, _numbers(rec.select("content_hash"), state.buckets))
    if looked_up is not None:
        paid = looked_up.select("lookup_key").distinct()
        _replaced(spark, state, new, "cached", None, paid, _numbers(paid, state.buckets))
    _save(spark, new)
    return new


def _index_of(spark: SparkSession, state: State, table: str, stored: DataFrame | None) -> DataFrame:
    """The keys under which an index has the touched people."""
    if stored is None:
        return spark.createDataFrame([], f"{KEY[table]} string")
    if table == "keys":  # what look-ups gave included
        mine = read(spark, state, "identities", _numbers(stored.select("candidate_id"), state.buckets)).join(stored.select("candidate_id").distinct(), "candidate_id", "left_semi")
        return mine.select(F.concat("itype", F.lit(":"), "match_key").alias("key"))
    return _names_of(stored).select("name")


def people(spark: SparkSession, state: State) -> People:
    """The stored tables as ``people.build`` gives them."""
    t = {name: read(spark, state, name) for name in (*BY_CANDIDATE, "records")}
    by = ["candidate_id", "field"]
    return People(t["records"], t["rows"], t["candidates"], t["identities"], history(t["folded"], by), t["change_log"], conflicts(t["folded"], by), t["declined"], t["merged"], t["folded"])
