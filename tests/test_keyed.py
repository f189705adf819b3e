"""The keyed streaming fold against the batch fold: late rows, replays, restarts; look-ups that expire."""

import random

import pytest
from pyspark.sql import functions as F

from kinfold.operators.fold import current, fold
from kinfold.plans import catalogue
from kinfold.streaming.keyed import fold_stream, lookups_stream, rocksdb_state

COLUMNS = "k string, ord long, value string, eq string, source string, time long, confidence double, rank int"


@pytest.fixture
def store(spark):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    rocksdb_state(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", old) if old else spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_fold_stream(spark, store, tmp_path):
    r = random.Random(4)
    rows = []
    for i in range(120):
        v = r.choice(["x", "y", "z", None])
        rows.append((r.choice("abc"), i, v, v, r.choice(["s", "t"]), r.randrange(40) * 1_000_000, r.choice([None, 0.5, 0.9]), r.randrange(2)))
    parts = [rows[:50], rows[50:80], rows[:20] + rows[80:]]  # the last file replays some
    for n, part in enumerate(parts):
        spark.createDataFrame(part, COLUMNS).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
        stream = spark.readStream.schema(COLUMNS).parquet(str(tmp_path / "in/*"))
        # Each run is a restart from the checkpoint.
        query = fold_stream(stream, "k").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        query.awaitTermination()
    steps = spark.read.parquet(str(tmp_path / "out"))
    got = {x.key: (x.value, x.source) for x in steps.where("applied").groupBy("key").agg(F.max_by(F.struct("value", "source"), "ord").alias("s")).select("key", "s.*").collect()}
    obs = spark.createDataFrame(rows, COLUMNS).withColumn("time", F.timestamp_micros("time"))
    folded = fold(obs, ["k"])
    assert got == {x.k: (x.current.value, x.current.source) for x in current(folded, ["k"]).collect()}
    pick = lambda df, k, new: sorted((x[k], x.ord, x.rule, x.applied) for x in df.collect())
    assert pick(steps, "key", "value") == pick(folded, "k", "new")


def test_rows_of_equal_order_are_all_folded(spark, store, tmp_path):
    """Few orders and many rows of each: by the batch fold's order without a tie, by ``tie`` with one; a replay changes nothing."""
    r = random.Random(5)
    rows = [(r.choice("abc"), r.randrange(12), *[r.choice(["x", "y", "z", None])] * 2, r.choice("st"), r.randrange(40) * 1_000_000, r.choice([None, 0.5, 0.9]), r.randrange(2), i) for i in range(150)]
    schema = COLUMNS + ", id long"
    late = [(k, 12 + o, *rest[:-1], 150 + rest[-1]) for k, o, *rest in rows[:40]]
    for name, tie in (("plain", None), ("tie", "id")):
        for n, part in enumerate([rows, rows[:30] + late]):
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}/in/{n}"))
            stream = spark.readStream.schema(schema).parquet(str(tmp_path / f"{name}/in/*"))
            fold_stream(stream, "k", tie).writeStream.format("parquet").option("path", str(tmp_path / f"{name}/out")).option("checkpointLocation", str(tmp_path / f"{name}/check")).trigger(availableNow=True).start().awaitTermination()
        steps = spark.read.parquet(str(tmp_path / f"{name}/out"))
        obs = spark.createDataFrame(rows + late, schema).withColumn("time", F.timestamp_micros("time"))
        if tie:
            obs = obs.withColumn("ord", F.col("ord") * 1000 + F.col("id"))
        folded = fold(obs if tie else obs.drop("id").distinct(), ["k"])
        applied = lambda df, k: sorted((x[k], x.version, x.rule) for x in df.where("applied").collect())
        assert applied(steps, "key") == applied(folded, "k") and steps.count() == folded.count()
        got = {x.key: (x.value, x.source) for x in steps.where("applied").groupBy("key").agg(F.max_by(F.struct("value", "source"), "version").alias("s")).select("key", "s.*").collect()}
        assert got == {x.k: (x.current.value, x.current.source) for x in current(folded, ["k"]).collect()}


def test_keyed_query_with_equal_orders(spark, tmp_path):
    """Two events of a user whose arrival is the same: the second is trusted more, and its value is the user's."""
    rows = [(1, 7, "view", 9.0, '{"k": "10"}'), (1 + 1_000_003, 7, "purchase", 9.0, '{"k": "90"}'), (2, 8, "view", 9.0, '{"k": "30"}')]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string").selectExpr("event_id", "timestamp_ntz'2024-01-01' AS ts", "user_id", "event_type", "value", "props")
    df.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = {x.user_id: (x.value, x.source) for x in catalogue.queries()["q54_keyed_stream"](spark, str(tmp_path)).collect()}
    assert got == {7: ("3", "purchase"), 8: ("1", "view")}


def test_misses_expire(spark, store, tmp_path):
    asked = [[("a", 0, False), ("b", 0, True)], [("a", 10, False), ("b", 40, True)], [("c", 45, True)], [("a", 50, True)], [("a", 90, False)]]
    for n, part in enumerate(asked):
        df = spark.createDataFrame(part, "lookup_key string, d int, found boolean").selectExpr("lookup_key", "timestamp'2024-01-01' + make_dt_interval(d) AS requested_at", "found")
        df.coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in/*"))
        lookups_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    first = spark.sql("SELECT unix_millis(timestamp'2024-01-01') AS x").first().x
    got = sorted((x.lookup_key, (x["at"] - first) // 86_400_000, x.state) for x in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", 0, "billed"), ("a", 10, "cached"), ("a", 30, "expired"), ("a", 50, "billed"), ("a", 90, "cached"), ("b", 0, "billed"), ("b", 40, "cached"), ("c", 45, "billed")]
