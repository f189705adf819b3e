"""Source divergence audit: how far the term distributions of a language's sources lie apart.

Groups are (lang, source). Each language keeps the terms that at least three of its documents hold. A group gives a kept
term p = 1 + floor(10**9 * (count + 1) / (N + V)), with N its occurrences of kept terms and V how many terms are kept; the
divergence of p from q on a term is floor((p - q)**2 / q). Everything is exact in integers.

1. *Count.* Texts are read once; a task adds up (lang, source, term) before the shuffle, which deals by (lang, term), so that
   a hot source is spread over all its terms.
2. *Slice.* A language's terms are dealt into shards of about ``SHARD`` counts. In a shard terms are numbered, and
   each group becomes one compressed slice: numbers and counts of the terms it has. So no task holds a whole group.
3. *Rotate.* A cell is a group's slice of a shard. Cells stay in their partition; in each round of a round-robin tournament
   (circle method) every group of a language meets one other, whose compressed slices travel to the cell that
   hosts the meeting, and both directions are evaluated there. Hosts alternate, so each cell hosts half of its
   meetings. Rounds are taken in waves of about ``WAVE_BYTES`` of travelling slices, each written before the next.
4. *Rank.* A cell keeps its 200 strongest terms against the language in a heap; heaps of a group's shards are merged by rank.

Defined results: null text, lang and source are read as ``''``; a group without terms still meets all others; a language
without kept terms has divergences of 0; repeated rows count each as a document; a language with one source has no
pairs; an empty table gives no rows; other columns are left out. Counts up to 9 * 10**15 a group are exact.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.text import steps
from kinfold.storage import stage
from kinfold.workers import map_arrow, ship

MIN_DOCS = 3
TOP = 200
UNIT = 10**9
#: Distinct terms that a task counts before it hands them on.
HELD = 200_000
#: Counts of a shard, and bytes of slices that travel in a wave.
SHARD = 250_000
WAVE_BYTES = 1 << 30

#: Bytes of terms in lower case, all others as a space: bytes from 0x80 on belong to characters outside ASCII.
_FOLD = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def _counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents) as sums of parts of the table."""

    def given(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            columns = [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in terms], pa.int64())]
            yield pa.record_batch(columns, names=["lang", "source", "term", "n", "docs"])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in steps(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for key, text in zip(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()), texts):
                terms = text.translate(_FOLD).split()
                n, docs = held.setdefault(key, (Counter(), Counter()))
                n.update(terms)
                docs.update(set(terms))
            if sum(len(n) for n, _ in held.values()) > HELD:
                yield from given(held)
        yield from given(held)

    return map_arrow(docs.select("lang", "source", "text"), run, "lang string, source string, term string, n long, docs long")


def _kept(docs: DataFrame) -> DataFrame:
    """lang, source, term, n of the kept terms, with lang_n (the language's count) and lead (true once a term)."""
    dealt = _counted(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # Of a term, a language has one row a source.
    term = Window.partitionBy("lang", "term")
    both = dealt.withColumns({"_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term), "lead": F.row_number().over(term.orderBy("source")) == 1})
    return both.where(F.col("_docs") >= MIN_DOCS).select("lang", "source", "term", "n", "lang_n", "lead")


def _squeeze(numbers: np.ndarray, *columns: np.ndarray) -> bytes:
    parts = [np.diff(numbers, prepend=0).astype("<u4").tobytes(), *[c.astype("<i8").tobytes() for c in columns]]
    return zlib.compress(b"".join(parts), 1)


def _expand(data: bytes | None, columns: int = 1) -> list[np.ndarray]:
    raw = zlib.decompress(data) if data is not None else b""
    n = len(raw) // (4 + 8 * columns)
    return [np.frombuffer(raw, "<u4", n).astype(np.int64).cumsum(), *[np.frombuffer(raw, "<i8", n, 4 * n + 8 * n * i) for i in range(columns)]]


def _sliced(sharded: DataFrame) -> DataFrame:
    """lang, shard, source, size (terms of the shard), counts, strong (counts of group and language), words; a shard is one bounded group."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("term", "ascending"), ("source", "ascending")]).combine_chunks()
        terms, sources = (table.column(c).combine_chunks().dictionary_encode() for c in ("term", "source"))
        number, owner = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (terms, sources))
        n, lang_n = (table.column(c).to_numpy() for c in ("n", "lang_n"))
        words = terms.dictionary.to_pylist()
        order = np.argsort(owner, kind="stable")
        rows = {"source": sources.dictionary.to_pylist(), "counts": [], "strong": [], "words": []}
        for at in np.split(order, np.cumsum(np.bincount(owner))[:-1]):
            rows["counts"].append(_squeeze(number[at], n[at]))
            rows["strong"].append(_squeeze(number[at], n[at], lang_n[at]))
            rows["words"].append(zlib.compress(" ".join(words[i] for i in number[at].tolist()).encode(), 1))
        k = len(rows["source"])
        lang, shard = table.column("lang")[0].as_py(), table.column("shard")[0].as_py()
        return pa.table({"lang": pa.array([lang] * k, pa.string()), "shard": pa.array([shard] * k, pa.int32()), "size": pa.array([len(words)] * k, pa.int64()), "source": pa.array(rows["source"], pa.string()), **{c: pa.array(rows[c], pa.binary()) for c in ("counts", "strong", "words")}})

    return sharded.groupBy("lang", "shard").applyInArrow(run, "lang string, shard int, size long, source string, counts binary, strong binary, words binary")


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / total), by long division where the product could leave a long."""
    above = counts.astype(np.int64) + 1
    if not len(above) or int(above.max()) < 2**63 // UNIT:
        return 1 + above * UNIT // total
    whole, rest = above // total, above % total
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // total, rest % total
    return 1 + whole


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def meet(a: list[np.ndarray], b: list[np.ndarray], totals: tuple[int, int], size: int) -> tuple[int, int]:
    """Divergence of a from b and of b from a over the ``size`` terms of a shard; a and b are numbers and counts."""
    both = np.union1d(a[0], b[0])
    p, q = (np.zeros(len(both), np.int64) for _ in range(2))
    p[np.searchsorted(both, a[0])], q[np.searchsorted(both, b[0])] = a[1], b[1]
    p, q = shares(np.append(p, 0), totals[0]), shares(np.append(q, 0), totals[1])
    rest = size - len(both)
    one, two = gaps(p, q), gaps(q, p)
    return tuple(int(x[:-1].sum()) + rest * int(x[-1]) for x in (one, two))


def _wave(cells: DataFrame, start: int, stop: int) -> DataFrame:
    """lang, host, guest, there, back of each meeting of rounds start to stop - 1, by shard."""
    i, r = F.col("player"), F.col("round")
    # Players 0 to last - 1 sit in a circle, the last stands: i and j meet in the round with i + j = 2r modulo last.
    last = F.col("players") + F.col("players") % 2 - 1
    other = F.pmod(2 * r - i, last)
    other = F.when(i == last, r).when(other == i, last).otherwise(other)
    guest = F.when((i + other) % 2 == 0, i > other).otherwise(i < other)
    rounds = F.sequence(F.lit(start), F.least(F.lit(stop), last.cast("int")) - 1)
    moving = cells.where(last > start).withColumn("round", F.explode(rounds)).withColumn("to", other).where((F.col("to") < F.col("players")) & guest)
    moving = moving.select("lang", "shard", F.col("to").alias("player"), F.col("player").alias("guest"), F.col("total").alias("guest_total"), F.col("counts").alias("guest_counts"))
    met = cells.select("lang", "shard", "player", "total", "size", "counts").join(moving, ["lang", "shard", "player"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.to_pydict()
            found = [meet(_expand(a), _expand(b), (s, t), size) for a, b, s, t, size in zip(x["counts"], x["guest_counts"], x["total"], x["guest_total"], x["size"])]
            yield pa.record_batch([batch.column("lang"), batch.column("player"), batch.column("guest"), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["lang", "host", "guest", "there", "back"])

    each = map_arrow(met.select("lang", "player", "guest", "total", "guest_total", "size", "counts", "guest_counts"), run, "lang string, host int, guest int, there long, back long")
    return each.groupBy("lang", "host", "guest").agg(F.sum("there").alias("there"), F.sum("back").alias("back"))


def _strongest(cells: DataFrame) -> DataFrame:
    """lang, source, item, value: the heap of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for x in batch.to_pylist():
                _, n, lang_n = _expand(x["strong"], 2)
                p, q = shares(n, x["total"]), shares(lang_n, x["lang_total"])
                at = np.flatnonzero(p > q)
                # Terms stand in UTF-8 order, so their places decide ties.
                best = heapq.nsmallest(TOP, zip((-gaps(p[at], q[at])).tolist(), at.tolist()))
                words = zlib.decompress(x["words"]).decode().split(" ") if best else []
                out += [(x["lang"], x["source"], words[i], -f) for f, i in best]
            if out:
                columns = list(zip(*out))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64()))], names=["lang", "source", "item", "value"])

    return map_arrow(cells.where("strong IS NOT NULL").select("lang", "source", "total", "lang_total", "strong", "words"), run, "lang string, source string, item string, value long")


def audit(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: all peers of every group, and its 200 strongest terms."""
    ship(docs.sparkSession)
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    kept = stage(_kept(docs), "terms")
    of_lang = kept.groupBy("lang").agg(F.count_if("lead").alias("terms"), F.sum("n").alias("lang_n"), F.count("*").alias("_rows"))
    groups = docs.select("lang", "source").distinct()
    player = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    seats = groups.withColumns({"player": player, "players": F.count("*").over(Window.partitionBy("lang"))})
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("_n"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    groups = stage(
        seats.join(own, ["lang", "source"], "left").join(of_lang, "lang", "left").select(
            "lang", "source", "player", F.col("players").cast("int").alias("players"), F.greatest(zero("_n") + zero("terms"), F.lit(1)).alias("total"), F.greatest(zero("lang_n") + zero("terms"), F.lit(1)).alias("lang_total"),
            F.greatest(F.ceil(zero("_rows") / SHARD), F.lit(1)).cast("int").alias("shards"),
        ), "groups",
    )
    shards = stage(groups.groupBy("lang").agg(F.first("shards").alias("shards")), "shards")
    sharded = kept.join(shards, "lang").select("lang", "source", "term", "n", "lang_n", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"))
    slices = stage(_sliced(sharded), "slices")
    sizes = slices.groupBy("lang", "shard").agg(F.first("size").alias("size"))
    seats = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    cells = seats.join(sizes, ["lang", "shard"], "left").join(slices.drop("size"), ["lang", "shard", "source"], "left").withColumn("size", zero("size"))
    cells = stage(cells, "cells")
    span = cells.agg(F.coalesce(F.sum(F.length("counts")), F.lit(0)).alias("bytes"), F.coalesce(F.max("players"), F.lit(1)).alias("players")).first()
    rounds = span.players + span.players % 2 - 1
    together = max(1, 2 * WAVE_BYTES // max(span.bytes, 1))
    resident = cells.select("lang", "shard", "player", "players", "total", "size", "counts").repartition("lang", "shard", "player")
    if rounds > together:
        resident = resident.persist(StorageLevel.DISK_ONLY)
    met = None
    for start in range(0, rounds, together):
        wave = stage(_wave(resident, start, min(start + together, rounds)), "wave")
        met = wave if met is None else met.unionByName(wave)
    if rounds > together:
        resident.unpersist()
    name = lambda c, a: groups.select("lang", F.col("player").alias(c), F.col("source").alias(a))
    both = met.join(name("host", "_host"), ["lang", "host"]).join(name("guest", "_guest"), ["lang", "guest"])
    side = lambda a, b, v: F.struct(F.col(a).alias("source"), F.col(b).alias("item"), F.col(v).alias("value"))
    pairs = both.select("lang", F.explode(F.array(side("_host", "_guest", "there"), side("_guest", "_host", "back"))).alias("x")).select("lang", "x.*")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    shape = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    strongest = _strongest(cells).withColumn("rank", rank).where(F.col("rank") <= TOP)
    return shape(pairs.withColumn("rank", rank), "pair").unionByName(shape(strongest, "term"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS MATERIALIZED (SELECT r, lang, source, unnest(terms) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM d),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
p AS MATERIALIZED (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 1) // (total + v) AS p
    FROM totals JOIN vocabulary USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
q AS (SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (sum(n) + 1) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v)) AS q FROM counts JOIN vocabulary USING (lang) GROUP BY lang, term),
apart AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
strong AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM strong))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
