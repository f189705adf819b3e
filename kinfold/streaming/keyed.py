"""The field fold as a stream with keyed state: each key keeps its current observation, and what a lookup missed expires.

State is one observation and one place in the order a key, however many rows it has had. Rows of a key that come again (a replayed
file, a restarted query) carry a place that the state has passed and change nothing; rows whose observation time is
late are no special case, since the fold goes by processing order and compares times itself. A key's rows of one micro-batch
are sorted in memory; the source's limit on a micro-batch (``maxFilesPerTrigger``, ``maxBytesPerTrigger``) bounds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kinfold.functions import policy as P
from kinfold.operators.fold import precedence
from kinfold.workers import ship

_CURRENT = "value string, eq string, source string, time long, confidence double, rank int, ord long"
_STEP = "key string, ord long, rule string, applied boolean, old_value string, value string, source string, time long, confidence double, version long"
#: Rows of equal ord and tie go by what they say, nulls first, as in the batch fold.
_ORDER = ["ord", "tie", "value", "eq", "source", "time", "confidence", "rank"]


class _Fold(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", _CURRENT)
        self.passed = handle.getValueState("passed", "ord long, tie long, versions long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _CURRENT.split(", ")]
        cur = dict(zip(names, self.current.get())) if self.current.exists() else None
        # What earlier micro-batches passed; rows of this one may share an order, and only those equal in everything are one row twice.
        *passed, versions = self.passed.get() if self.passed.exists() else (None, None, 0)
        before, out, last = cur, [], passed
        frame = pd.concat(list(rows))
        records = frame.astype(object).where(frame.notna(), None).to_dict("records")
        for _, row in sorted({tuple((r[c] is not None, r[c]) for c in _ORDER): r for r in records}.items()):
            place = [int(row["ord"]), int(row["tie"])]
            if passed[0] is not None and place <= passed:
                continue
            last, at = place, place[0]
            new = {n: row[n] for n in names}
            if new["value"] is None:
                if cur is not None:
                    out.append((key[0], at, "REJECTED:null_from_source_is_not_deletion", False, cur["value"], None, new["source"], new["time"], new["confidence"], None))
                continue
            if cur is None:
                wins, rule = True, "fill_value"
            elif cur["eq"] == new["eq"]:
                continue
            else:
                wins, rule = precedence(cur, new)
            out.append((key[0], at, rule, wins, cur and cur["value"], new["value"], new["source"], new["time"], new["confidence"], versions if wins else None))
            cur, versions = (new, versions + 1) if wins else (cur, versions)
        if cur is not before:
            self.current.update(tuple(cur[n] for n in names))
        if last is not passed:
            self.passed.update((*last, versions))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _STEP.split(", ")])

    def close(self) -> None:
        pass


def fold_stream(observations: DataFrame, key: str, tie: str | None = None) -> DataFrame:
    """The steps of the fold (changes, kept incumbents, refused nulls) as they happen; the state is the current observation.

    ``observations``: key, ord (long, rising with arrival for each key), value, eq, source, time (microseconds), confidence, rank.
    ``tie`` (a column, long) orders a key's rows of equal ord and rises with arrival among them. Without it they must come in one
    micro-batch: a later one takes an order that was passed for a replay. Applied steps are numbered by version, from 0 for each key.
    Needs a state store that takes several states a key (``rocksdb_state``).
    """
    ship(observations.sparkSession)
    rows = observations.selectExpr(f"CAST({key} AS STRING) AS key", "ord", f"CAST({tie or 0} AS LONG) AS tie", "value", "eq", "source", "time", "confidence", "rank")
    return rows.groupBy("key").transformWithStateInPandas(_Fold(), _STEP, "append", "none")


class _Misses(StatefulProcessor):
    """Keys that a look-up missed, until their time to live is over."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.asked = handle.getValueState("asked", "at long, found boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values("at", kind="stable")
        out = []
        for row in frame.to_dict("records"):
            at, found = int(row["at"]), bool(row["found"])
            if self.asked.exists():
                then, was = self.asked.get()
                if was or at < then + self.ttl_ms:
                    out.append((key[0], at, "cached"))
                    continue
            self.asked.update((at, found))
            if not found:
                self.handle.registerTimer(at + self.ttl_ms)
            out.append((key[0], at, "billed"))
        yield pd.DataFrame(out, columns=["lookup_key", "at", "state"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.asked.exists():
            then, was = self.asked.get()
            if not was and then + self.ttl_ms <= expiredTimerInfo.getExpiryTimeInMs():
                self.asked.clear()
                yield pd.DataFrame([(key[0], expiredTimerInfo.getExpiryTimeInMs(), "expired")], columns=["lookup_key", "at", "state"])

    def close(self) -> None:
        pass


def lookups_stream(requests: DataFrame, *, ttl_days: int = P.NEGATIVE_TTL_DAYS, delay: str = "0 seconds") -> DataFrame:
    """lookup_key, at, state of requests (lookup_key, requested_at, found): billed, or cached while the answer is known.

    A found key is known for good, a missed one for ``ttl_days`` of event time; a timer then clears its state and reports ``expired``.
    """
    ship(requests.sparkSession)
    rows = requests.withWatermark("requested_at", delay).selectExpr("lookup_key", "requested_at", "unix_millis(requested_at) AS at", "found")
    return rows.groupBy("lookup_key").transformWithStateInPandas(_Misses(ttl_days * 86_400_000), "lookup_key string, at long, state string", "append", "eventTime")


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def rocksdb_state(spark) -> None:
    """Several states a key need the RocksDB store."""
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextmanager
def with_rocksdb(spark) -> Iterator[None]:
    """The RocksDB store for queries that start inside."""
    before = spark.conf.get(_PROVIDER, None)
    rocksdb_state(spark)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)
