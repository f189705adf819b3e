"""Line dedup by a segment-partition edit join.

Two lines are near copies if their edit distance (insert, delete, substitute one code point) is at
most ``threshold`` and both have ``min_chars`` code points; with ``short``, shorter lines that aren't blank
take part too, as copies of equal lines only. The steps:

1. equal lines become one (by the 128 bits of XXH3), with their first place (doc_id, line number);
2. a line of length l is cut into threshold + 1 segments. A line within the threshold has one of them
   unchanged at a place that the length difference bounds, so each line writes its own segments to
   an index, and probes the index of each length from its own down to ``threshold`` less with the
   substrings that the multi-match-aware bounds leave;
3. equal keys make candidates, unless the parities of their character counts already differ in more
   bits than ``threshold`` edits can flip;
4. candidates are verified on their texts by the banded bit-parallel edit distance, pairs of like length in
   step; beyond LONG code points, and what both ends share taken off, by the furthest reach of each diagonal.

Links join lines into classes; a class keeps its first line. Keys are dealt by hash and streamed in
sorted order. A key with more than HOT lines (counted on a sample of lines, so about) is dealt onto pairs of
salted blocks: each block of index lines meets each block of probes under a key of its own, so that a task
holds two blocks at a time and the pairs of a key are spread over the tasks. A line that a
task has seen isn't written again, so that a line with most of the rows is a few rows a key and task; these
become one as they arrive. All candidates of a key are still compared: many lines of one length that share
a segment cost the square of their number, in numpy, whatever few of them are links.

Defined results: null text has no lines; blank lines, and without ``short`` those below ``min_chars``, are kept and have no class; repeated rows and
rows that share a doc_id share places, so that the first place of a class is kept in each of them; a
document with a null id stands before all others; an empty table gives no rows; other columns pass, but for
one called n_removed, which the count replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.text import Rolling, mix, steps, unused
from kinfold.operators.components import connected_components
from kinfold.storage import stage
from kinfold.workers import map_arrow

THRESHOLD = 2
MIN_CHARS = 20
#: Line hashes that a task remembers, and lines of a key compared at a time.
SEEN, BLOCK = 400_000, 1024
#: Lines of a key from which it is dealt onto block pairs; one line in SAMPLE is counted.
HOT, SAMPLE = 4096, 16
#: Lines whose place is broadcast to fetch their text; beyond, the documents are shuffled.
BROADCAST_LINES = 100_000

#: Cells of a verification step, and code points from which a pair is verified alone.
CELLS, LONG = 4_000_000, 20_000

#: Bytes of text in a step: code points and their hashes take some sixty times as much.
STEP = 1_000_000

#: Layout of ``info``, from the low end: written to the index, probes it, length, parities.
INDEX, PROBE, _LENGTH, _PARITY_BITS = np.uint64(1), np.uint64(2), np.uint64(0x3FFF), 48


class Lines:
    """Lines of some texts in one array of code points: start, stop, text and number of each."""

    def __init__(self, texts: pa.Array):
        values = [x or "" for x in texts.to_pylist()]
        self.lines = [line for x in values for line in x.split("\n")]
        joined = "\n".join(values) + "\n"
        self.codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.flatnonzero(self.codes == 10)
        self.start, self.stop = np.concatenate(([0], ends[:-1] + 1)), ends
        per_text = np.array([x.count("\n") + 1 for x in values])
        self.text = np.repeat(np.arange(len(values)), per_text)
        self.number = np.arange(len(ends)) - np.repeat(np.cumsum(per_text) - per_text, per_text)

    def take(self, keep: np.ndarray) -> None:
        self.lines = [self.lines[i] for i in np.flatnonzero(keep).tolist()]
        self.start, self.stop, self.text, self.number = (x[keep] for x in (self.start, self.stop, self.text, self.number))

    def blank(self) -> np.ndarray:
        """Lines of nothing but spaces and control characters of that kind."""
        words = np.concatenate(([0], np.cumsum((self.codes != 32) & ((self.codes < 9) | (self.codes > 13)))))
        return words[self.stop] == words[self.start]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of each line's XXH3."""
        import xxhash

        digests = b"".join(xxhash.xxh3_128_digest(line.encode()) for line in self.lines)
        both = np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2)
        return both[:, 0], both[:, 1]


def line_places(docs: DataFrame, min_chars: int, short: bool = False) -> DataFrame:
    """doc_id, text_hash, line, h1, h2 of every line that takes part; ``docs`` has doc_id, text, text_hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", STEP):
            x = Lines(batch.column("text"))
            x.take((x.stop - x.start >= min_chars) | (short & ~x.blank()))
            h1, h2 = x.hashes()
            row = pa.array(x.text)
            yield pa.record_batch(
                [batch.column("doc_id").take(row), batch.column("text_hash").take(row), pa.array(x.number.astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], names=["doc_id", "text_hash", "line", "h1", "h2"]
            )

    return map_arrow(docs, run, "doc_id long, text_hash long, line int, h1 long, h2 long")


def segment(length: np.ndarray, i: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Where segment i of a line of that length begins and ends."""
    return length * i // parts, length * (i + 1) // parts


def segment_keys(x: Lines, rolling: Rolling, threshold: int, min_chars: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.uint64]]:
    """(line indexes, keys, INDEX and PROBE bits) of all segments and of all probes.

    A line's own segments are index and probe in one row: they find lines of its length at no shift.
    """
    length, parts = x.stop - x.start, threshold + 1
    tag = lambda n, i: mix(n.astype(np.uint64) * np.uint64(64) + np.uint64(i))
    for i in range(parts):
        for less in range(threshold + 1):
            other = length - less
            a, b = segment(other, i, parts)
            for move in range(max(-i, less - (threshold - i)), min(i, less + threshold - i) + 1):
                at = np.flatnonzero((other >= min_chars) & (a + move >= 0) & (b + move <= length))
                own = less == 0 and move == 0
                yield at, rolling.of((x.start + a + move)[at], (x.start + b + move)[at]) ^ tag(other[at], i), INDEX | PROBE if own else PROBE


def line_keys(docs: DataFrame, threshold: int, min_chars: int, hot: tuple[np.ndarray, np.ndarray] | None = None, sample: int = 1) -> DataFrame:
    """key, h1, info: info holds the parities of character counts, the length, and whether the key is of the index or a probe.

    ``hot`` has keys (sorted) and into how many blocks to deal each; of ``sample`` lines one is taken, by its hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in steps(batches, "text", STEP):
            x = Lines(batch.column("text"))
            x.take(x.stop - x.start >= min_chars)
            h1, rolling = x.hashes()[0], Rolling(x.codes)
            if len(seen) > SEEN:
                seen = set()
            fresh = np.array([h % sample == 0 and h not in seen and not seen.add(h) for h in h1.tolist()], bool)
            x.take(fresh)
            if not len(x.start):
                continue
            h1, length = h1[fresh], x.stop - x.start
            bit = np.uint64(1) << ((x.codes * np.uint32(0x9E3779B1) >> np.uint32(8)) % np.uint32(_PARITY_BITS)).astype(np.uint64)
            running = np.concatenate((np.zeros(1, np.uint64), np.bitwise_xor.accumulate(bit)))
            info = ((running[x.stop] ^ running[x.start]) << np.uint64(16)) | ((length.astype(np.uint64) & _LENGTH) << np.uint64(2))
            for at, key, kind in segment_keys(x, rolling, threshold, min_chars):
                for k, h, i in dealt_keys(key, h1[at], info[at] | kind, hot):
                    yield pa.record_batch([pa.array(k.view(np.int64)), pa.array(h.view(np.int64)), pa.array(i.view(np.int64))], names=["key", "h1", "info"])

    return map_arrow(docs.select("text"), run, "key long, h1 long, info long")


def dealt_keys(key: np.ndarray, h: np.ndarray, info: np.ndarray, hot: tuple[np.ndarray, np.ndarray] | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The rows; those of hot keys once for each block of the other kind, under the key of that pair of blocks."""
    if hot is None or not len(hot[0]):
        yield key, h, info
        return
    at = np.minimum(np.searchsorted(hot[0], key), len(hot[0]) - 1)
    is_hot = hot[0][at] == key
    yield key[~is_hot], h[~is_hot], info[~is_hot]
    if not is_hot.any():
        return
    key, h, info, blocks = key[is_hot], h[is_hot], info[is_hot], hot[1][at[is_hot]].astype(np.uint64)
    own = mix(h ^ key) % blocks
    for other in range(int(blocks.max())):
        other = np.uint64(other)
        for kind in (INDEX, PROBE):
            on = np.flatnonzero((blocks > other) & (info & kind > 0))
            i, j = (own[on], other) if kind == INDEX else (other, own[on])
            yield mix(key[on] + mix(i * np.uint64(1 << 32) + j + np.uint64(1))), h[on], info[on] & ~(INDEX | PROBE) | kind


def hot_keys(docs: DataFrame, threshold: int, min_chars: int, hot: int = HOT, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Keys (sorted) of more than about ``hot`` lines, and into how many blocks to deal each."""
    counts = line_keys(docs, threshold, min_chars, sample=sample).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") * sample > hot)
    found = counts.toPandas()
    keys, n = found["key"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64) * sample
    by = np.argsort(keys)
    return keys[by], -(-n[by] // hot)


def _candidates(h: np.ndarray, info: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one key's index rows and probe rows that lengths and parities allow, block by block."""
    left, right = np.flatnonzero(info & INDEX), np.flatnonzero(info & PROBE)
    length, parity = (info >> np.uint64(2)) & _LENGTH, info >> np.uint64(16)
    for a in range(0, len(left), BLOCK):
        for b in range(0, len(right), BLOCK):
            i, j = left[a : a + BLOCK, None], right[None, b : b + BLOCK]
            # A probe goes to lines as long as its own or shorter; equal lengths are met twice, once is enough.
            more = (length[j] - length[i]) & _LENGTH
            ok = (h[i] != h[j]) & (more <= threshold) & ((more > 0) | (h[i] < h[j]))
            ok &= np.bitwise_count(parity[i] ^ parity[j]) <= 2 * threshold
            r, c = np.nonzero(ok)
            if len(r):
                yield h[i[r, 0]], h[j[0, c]]


def candidate_pairs(keys: DataFrame, threshold: int) -> DataFrame:
    """a, b: hashes of lines that share a key; the rows of a key arrive one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, full = [np.zeros(0, np.uint64)] * 3, 4 * HOT

        def pairs(key, h, info):
            edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.append(edges, len(key)))
            indexed = np.bitwise_or.reduceat(info & INDEX, edges) > 0
            several = np.maximum.reduceat(h, edges) != np.minimum.reduceat(h, edges)
            for e in np.flatnonzero(indexed & several):
                s = slice(edges[e], edges[e] + size[e])
                both = np.unique(np.stack((h[s], info[s])), axis=1)
                yield from _candidates(both[0], both[1], threshold)

        def emit(found):
            found = list(found)
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
                yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            now = [np.concatenate((r, c.to_numpy(zero_copy_only=False).view(np.uint64))) for r, c in zip(rest, batch.columns)]
            # The last key may go on in the next batch; what tasks have written of one line becomes one row.
            cut = np.searchsorted(now[0].view(np.int64), now[0][-1:].view(np.int64))[0] if len(now[0]) else 0
            rest = [x[cut:] for x in now]
            if len(rest[0]) > full:
                h, info = np.unique(np.stack(rest[1:]), axis=1)
                rest, full = [rest[0][: len(h)], h, info], max(4 * HOT, 2 * len(h))
            if cut:
                yield from emit(pairs(*(x[:cut] for x in now)))
        if len(rest[0]):
            yield from emit(pairs(*rest))

    dealt = keys.repartition("key").sortWithinPartitions("key")
    return map_arrow(dealt, run, "a long, b long").distinct()


def banded_distance(left: list[str], right: list[str], threshold: int) -> np.ndarray:
    """Edit distances of pairs whose lengths differ by at most ``threshold`` (right at least as long); above the threshold, some larger number.

    Hyyro's bit-vector recurrence on the band of 2 * threshold + 1 diagonals, one machine word a
    pair: bit b of step j stands for the row j - threshold + b.
    """
    n, band = len(left), 2 * threshold + 1
    rows, cols = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    width = int(max(cols.max(initial=0), rows.max(initial=0))) + band
    s, t = np.zeros((n, width + 2 * band), np.uint32), np.full((n, width), 0xFFFFFFFF, np.uint32)
    for i, (a, b) in enumerate(zip(left, right)):
        s[i, band : band + len(a)] = np.frombuffer(a.encode("utf-32-le"), np.uint32) + 1
        t[i, : len(b)] = np.frombuffer(b.encode("utf-32-le"), np.uint32) + 1
    full, one = np.uint64((1 << band) - 1), np.uint64(1)
    vp, vn = np.full(n, (((1 << band) - 1) << threshold) & ((1 << band) - 1), np.uint64), np.zeros(n, np.uint64)
    distance = np.minimum(rows, threshold)
    for j in range(int(cols.max(initial=0))):
        match = np.zeros(n, np.uint64)
        for b in range(band):
            match |= (s[:, band + j - threshold + b] == t[:, j]).astype(np.uint64) << np.uint64(b)
        d0 = ((((match & vp) + vp) ^ vp) | match | vn) & full
        hp, hn = (vn | ~(d0 | vp)) & full, d0 & vp
        on_diagonal, inside = j < rows - threshold, j < cols
        # The lowest diagonal until it reaches the last row, then along that row.
        drop = (d0 >> np.uint64(band - 1)) & one == 0
        last = np.clip(band - 2 - (j - (rows - threshold)), 0, band - 1).astype(np.uint64)
        along = ((hp >> last) & one).astype(np.int64) - ((hn >> last) & one).astype(np.int64)
        distance += np.where(inside, np.where(on_diagonal, drop, along), 0)
        vp, vn = (hn | ~((d0 >> one) | hp)) & full, (d0 >> one) & hp
    return distance


def _alike(x: np.ndarray, y: np.ndarray) -> int:
    """How many values both begin with."""
    n, at, step = min(len(x), len(y)), 0, 64
    while at < n:
        differ = np.flatnonzero(x[at : min(at + step, n)] != y[at : min(at + step, n)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 4
    return n


def within(x: np.ndarray, y: np.ndarray, threshold: int) -> bool:
    """Whether two sequences of code points lie within the threshold: for each number of edits, how far each diagonal reaches."""
    reach = {0: _alike(x, y)}
    for edits in range(threshold + 1):
        if reach.get(len(x) - len(y), -1) >= len(x):
            return True
        step = {}
        for d in range(-edits - 1, edits + 2):
            i = max(reach.get(d, -2) + 1, reach.get(d + 1, -2), reach.get(d - 1, -2) + 1)
            i = min(i, len(x), len(y) + d)
            if i >= max(0, d):
                step[d] = i + _alike(x[i:], y[i - d :])
        reach = step
    return False


def verified(pairs: DataFrame, threshold: int) -> DataFrame:
    """Of a, b, ta, tb those within the threshold."""

    def near(left: list[str], right: list[str]) -> np.ndarray:
        out = np.zeros(len(left), bool)
        codes = lambda text: np.frombuffer(text.encode("utf-32-le"), np.uint32)
        by, at = sorted(range(len(left)), key=lambda i: len(right[i])), 0
        while at < len(by):
            if len(right[by[at]]) > LONG:
                x, y = codes(left[by[at]]), codes(right[by[at]])
                out[by[at]] = within(x, y, threshold)
                at += 1
                continue
            stop = at + 1
            while stop < len(by) and len(right[by[stop]]) <= LONG and (stop + 1 - at) * (len(right[by[stop]]) + 8 * threshold + 4) <= CELLS:
                stop += 1
            some = by[at:stop]
            out[some] = banded_distance([left[i] for i in some], [right[i] for i in some], threshold) <= threshold
            at = stop
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for wide in steps(batches, "ta"):
            for part in steps([wide], "tb"):
                both = [sorted(x, key=len) for x in zip(part.column("ta").to_pylist(), part.column("tb").to_pylist())]
                found = pa.array(near([x[0] for x in both], [x[1] for x in both]))
                yield pa.record_batch([part.column("a").filter(found), part.column("b").filter(found)], names=["a", "b"])

    return map_arrow(pairs, run, "a long, b long")


def line_classes(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, short: bool = False) -> DataFrame:
    """doc_id, text_hash, line, first (doc_id and line of its class), n_links of every line that takes part."""
    places = stage(line_places(docs, min_chars, short), "lines")
    place = F.struct("doc_id", "line")
    distinct = stage(places.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line", "text_hash")).alias("p")), "distinct-lines")
    pairs = stage(candidate_pairs(line_keys(docs, threshold, min_chars, hot_keys(docs, threshold, min_chars)), threshold), "line-pairs")
    # The text of candidates, from the first place of each.
    wanted = pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct()
    wanted = stage(distinct.join(wanted, F.col("h1") == F.col("h")).groupBy(F.col("p.doc_id").alias("d"), F.col("p.text_hash").alias("t")).agg(F.collect_list(F.struct("h", "h2", "p.line")).alias("l")), "wanted")
    n = wanted.agg(F.coalesce(F.sum(F.size("l")), F.lit(0))).first()[0]
    near = F.broadcast(wanted) if n <= BROADCAST_LINES else wanted
    found = docs.join(near, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))).select(F.split("text", "\n", -1).alias("s"), F.explode("l").alias("l"))
    texts = stage(found.select(F.col("l.h").alias("h"), F.col("l.h2").alias("h2"), F.get("s", F.col("l.line")).alias("text")).dropDuplicates(["h"]), "line-texts")
    left, right = (texts.select(F.col("h").alias("h" + end), F.col("text").alias("t" + end)) for end in "ab")
    links = stage(verified(pairs.join(left, F.col("a") == F.col("ha")).join(right, F.col("b") == F.col("hb")).select("a", "b", "ta", "tb"), threshold), "links")
    # A node is the line whose text has been compared: it has both hashes.
    node = texts.select("h", F.col("h2").alias("node2"))
    nodes = stage(connected_components(links).join(node, F.col("node") == F.col("h")).select("node", "node2", "component"), "line-components")
    counts = links.select("a").union(links.select("b")).groupBy("a").agg(F.count("*").alias("n_links")).withColumnRenamed("a", "linked")
    member = distinct.join(nodes, (F.col("h1") == F.col("node")) & (F.col("h2") == F.col("node2")))
    first = member.groupBy("component").agg(F.min(F.struct("p.doc_id", "p.line")).alias("first")).withColumnRenamed("component", "c")
    named = stage(nodes.join(first, F.col("component") == F.col("c")).join(counts, F.col("node") == F.col("linked")).select("node", "node2", "first", "n_links"), "line-names")
    own = distinct.join(named, (F.col("h1") == F.col("node")) & (F.col("h2") == F.col("node2")), "left").select(
        F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.coalesce("first", F.struct("p.doc_id", "p.line")).alias("first"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    own = stage(own, "line-owners")
    return places.join(own, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))).select("doc_id", "text_hash", "line", "first", "n_links", (F.struct("doc_id", "line") == F.col("first")).alias("kept"))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, short: bool = False) -> DataFrame:
    """``docs`` with the lines removed that aren't the first of their class; n_removed counts them."""
    classes = line_classes(_keyed(docs, doc_id, text), threshold, min_chars, short)
    d, h, lines = unused(docs.columns, "_d", "_h", "_gone")
    gone = classes.where(~F.col("kept")).groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias(lines)).withColumnsRenamed({"doc_id": d, "text_hash": h})
    hashed = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    joined = docs.join(gone, F.col(doc_id).cast("long").eqNullSafe(F.col(d)) & (hashed == F.col(h)), "left")
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda s, i: ~F.array_contains(lines, i)), "\n")
    out = {text: F.when(F.col(lines).isNull(), F.col(text)).otherwise(kept).alias(text)}
    return joined.select(*[out.get(c, F.col(c)) for c in docs.columns if c.lower() != "n_removed"], F.coalesce(F.size(lines), F.lit(0)).alias("n_removed"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_classes(_keyed(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text"), short=True)
    return found.select("doc_id", "line", F.col("first.doc_id").alias("class_doc_id"), F.col("first.line").alias("class_line"), "n_links", "kept")
