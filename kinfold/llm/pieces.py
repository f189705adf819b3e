"""SentencePiece encoding and decoding, with segmentations sampled by Gumbel top-k without replacement.

The vocabulary is that of a SentencePiece model with byte fallback. A text's segmentations are the
paths of the lattice of all its pieces; a path's weight is the product of its pieces'. BPE models
order pieces by merge rank and hold no probabilities, so a piece's weight follows Zipf's law in its
rank: ``-log(rank + 10)`` less a constant, times ``sharpness``.

Perturbing every path's log probability with an independent Gumbel and taking the k largest samples k
distinct paths without replacement. They are found by A-star search, top down: a node of the search
(the paths that share a prefix) has as its bound the maximum of their perturbed values, a Gumbel
located at the log of their mass. Splitting a node, one child (drawn by mass, which the backward sums
of the lattice give) inherits the bound and the set of all others gets a Gumbel truncated below it; so
the first path is one forward draw, every position of it leaves one set of siblings on the heap, and
each further path continues from the set with the largest bound. All texts of a step advance together.

Pieces never hold a space after another character, so the lattice falls apart before every run of
spaces; equal parts share one lattice. Random numbers are hashes of (seed, row key, draw, place), so
that a row's samples don't depend on how rows are batched.

The inclusion score is P(perturbed value > kappa), kappa being the (k+1)-th largest value: with it,
sums over the sample weighted by probability / score are unbiased.

Defined results: null and empty texts have one segmentation, the empty one; a text with fewer than k
segmentations returns all, with inclusion 1; a null key counts as key 0; repeated rows get the same samples;
an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.text import LONG_WORD, Rolling, mix, steps
from kinfold.workers import map_arrow

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
K = 2
SEED = 7
STEP = 2_500_000
SPACE = "▁"


class Vocabulary:
    """Pieces of a SentencePiece model: for lookup by hash, and for decoding as bytes."""

    def __init__(self, model: str = MODEL, sharpness: float = 1.0):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        texts = [sp.id_to_piece(i) for i in range(size)]
        self.byte_id = np.zeros(256, np.int32)
        plain = []
        for i, piece in enumerate(texts):
            if sp.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain.append(i)
        if any(SPACE in texts[i].lstrip(SPACE) for i in plain):
            raise ValueError("a piece holds a space after another character")
        rank = np.zeros(size)
        rank[sorted(plain, key=lambda i: (-sp.get_score(i), i))] = np.arange(len(plain))
        weight = -sharpness * (np.log(rank + 10) + np.log(np.log(size)))
        self.fallback = -sharpness * (np.log(size) + np.log(np.log(size)))
        codes = [np.array([*map(ord, texts[i])], np.uint64) for i in plain]
        length = np.array([len(c) for c in codes])
        ends = np.cumsum(length)
        hashes = Rolling(np.concatenate(codes)).of(ends - length, ends)
        order = np.argsort(hashes)
        self.hashes, self.ids, self.weights = hashes[order], np.array(plain, np.int32)[order], weight[plain][order]
        self.longest = int(length.max())
        # Two tables addressed by different bits of the hash; a piece is in the first that has room.
        self.mask = np.uint64((1 << 20) - 1)
        self.tables = np.full((2, 1 << 20), -1, np.int32)
        for slot, h in enumerate(self.hashes):
            for table, at in zip(self.tables, self._slots(h)):
                if table[at] < 0:
                    table[at] = slot
                    break
            else:
                raise ValueError("two tables don't hold this vocabulary")
        raw = [b""] * size
        for i in plain:
            raw[i] = texts[i].replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_id.tolist()):
            raw[i] = bytes([b])
        self.raw_bounds = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    def _slots(self, h):
        return h & self.mask, (h >> np.uint64(40)) & self.mask

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are pieces, and the place of each in ``ids`` and ``weights``."""
        one, two = self._slots(h)
        slot = self.tables[0][one]
        hit = self.hashes[slot] == h
        hit[slot < 0] = False
        other = np.flatnonzero(~hit & (self.tables[1][two] >= 0))
        second = self.tables[1][two[other]]
        found = self.hashes[second] == h[other]
        slot[other[found]] = second[found]
        hit[other[found]] = True
        return hit, slot

    def bytes_of(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids, and where each id's begin."""
        start, size = self.raw_bounds[ids], self.raw_bounds[ids + 1] - self.raw_bounds[ids]
        ends = np.cumsum(size)
        at = np.repeat(start - ends + size, size) + np.arange(size.sum())
        return self.raw[at].tobytes(), np.concatenate(([0], ends))

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of some ids, without the space that encoding puts in front."""
        return self.bytes_of(ids)[0][1:]


class Lattice:
    """Lattices of the distinct parts of some texts; arcs are grouped by the node they leave.

    Node numbers are places in the parts' code points; the end of a part is its own node.
    """

    def __init__(self, vocabulary: Vocabulary, texts: list[str]):
        import xxhash

        self.v = vocabulary
        marked = [" " + x if x else "" for x in texts]
        codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in marked])))
        gap = codes == 32
        begins = gap.copy()
        begins[1:] &= ~gap[:-1]
        begins[bounds[:-1][bounds[:-1] < len(codes)]] = True
        start = np.flatnonzero(begins)
        stop = np.append(start[1:], len(codes))
        self.first = np.searchsorted(start, bounds)
        # Literal marks can't be told from spaces as pieces; they go the way of unknown characters.
        literal = codes == ord(SPACE)
        codes = np.where(gap, np.uint64(ord(SPACE)), codes)
        codes[literal] = np.uint64(0x110000)
        hashes = Rolling(codes).of(start, stop)
        for i in np.flatnonzero(stop - start > LONG_WORD).tolist():  # the polynomial is weak on long ones
            hashes[i] = xxhash.xxh64_intdigest(codes[start[i] : stop[i]].tobytes())
        _, sample, self.part = np.unique(hashes, return_index=True, return_inverse=True)
        size = (stop - start)[sample]
        begin = np.cumsum(size + 1) - size - 1
        self.begin, self.end = begin, begin + size
        chars = np.zeros(int((size + 1).sum()), np.uint64)
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        chars[at] = codes[np.repeat(start[sample] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        self._arcs(chars, np.repeat(self.end, size + 1))
        self._backward(np.repeat(size, size + 1) - (np.arange(len(chars)) - np.repeat(begin, size + 1)))

    def _arcs(self, chars: np.ndarray, end: np.ndarray) -> None:
        v, rolling, found = self.v, Rolling(chars), []
        node = np.arange(len(chars))
        single = np.zeros(len(chars), bool)
        for n in range(1, v.longest + 1):
            node = node[node + n <= end[node]]
            if not len(node):
                break
            h = rolling.of(node, node + n)
            hit, slot = v.find(h)
            if n == 1:
                single[node[hit]] = True
            found.append((node[hit], np.full(hit.sum(), n), v.ids[slot[hit]], v.weights[slot[hit]]))
        # Characters that are no piece are spelled in bytes: id -1 - code point stands for them.
        alone = np.flatnonzero(~single & (np.arange(len(chars)) < end))
        code = np.where(chars[alone] == 0x110000, ord(SPACE), chars[alone]).astype(np.int64)
        spelled = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        found.append((alone, np.ones(len(alone), int), (-1 - code).astype(np.int32), spelled * v.fallback))
        tail, step, ids, weight = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(tail, kind="stable")
        self.tail, self.head, self.ids, self.weight = tail[order], (tail + step)[order], ids[order], weight[order]
        self.out = np.searchsorted(self.tail, np.arange(len(chars) + 1))

    def _backward(self, left: np.ndarray) -> None:
        """Log sums over all completions, from the ends of all parts at once; then arc probabilities."""
        beta = np.zeros(len(left))
        by_left = np.argsort(left[self.tail], kind="stable")
        cuts = np.searchsorted(left[self.tail][by_left], np.arange(1, left.max(initial=0) + 2))
        for a, b in zip(cuts, cuts[1:]):
            arcs = by_left[a:b]
            if len(arcs):
                node = self.tail[arcs]
                edge = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
                value = self.weight[arcs] + beta[self.head[arcs]]
                top = np.maximum.reduceat(value, edge)
                total = np.add.reduceat(np.exp(value - np.repeat(top, np.diff(np.append(edge, len(arcs))))), edge)
                beta[node[edge]] = top + np.log(total)
        self.beta = beta
        self.log_p = np.minimum(self.weight + beta[self.head] - beta[self.tail], 0.0)
        # Likely arcs first, so that a draw seldom looks beyond a node's first arc.
        order = np.argsort(self.tail - np.exp(self.log_p) / 2)
        self.head, self.ids, self.weight, self.log_p = self.head[order], self.ids[order], self.weight[order], self.log_p[order]
        share = np.cumsum(np.exp(self.log_p))
        count = np.diff(self.out)
        before = np.concatenate(([0.0], share))[self.out[:-1]]
        self.reach = share - np.repeat(before, count)
        self.reach[self.out[1:][count > 0] - 1] = 2.0

    def log_rest(self, arcs: np.ndarray) -> np.ndarray:
        """The log of the mass of each arc's siblings: 1 - p, but where that cancels (a node's first arc) their sum."""
        rest = -np.expm1(self.log_p[arcs])
        most = np.flatnonzero(rest < 1e-6)
        node = self.tail[arcs[most]]
        count = self.out[node + 1] - self.out[node] - 1
        others = np.repeat(self.out[node] + 1 - np.cumsum(count) + count, count) + np.arange(count.sum())
        rest[most] = np.bincount(np.repeat(np.arange(len(most)), count), np.exp(self.log_p[others]), len(most))
        with np.errstate(divide="ignore"):
            return np.log(rest)

    def draw(self, node: np.ndarray, end: np.ndarray, uniform) -> tuple[np.ndarray, np.ndarray]:
        """Walks from nodes to ends by arc probability: the arcs in order, and how many each walk took.

        ``uniform(walks, step)`` gives the random numbers of a step.
        """
        walks, arcs, owners, step = np.arange(len(node)), [], [], 0
        node = node.copy()
        open_ = node < end
        walks = walks[open_]
        while len(walks):
            at = node[walks]
            arc, u = self.out[at], uniform(walks, step)
            on = np.flatnonzero(u > self.reach[arc])
            while len(on):
                arc[on] += 1
                on = on[u[on] > self.reach[arc[on]]]
            arcs.append(arc)
            owners.append(walks)
            node[walks] = self.head[arc]
            walks = walks[node[walks] < end[walks]]
            step += 1
        if not arcs:
            return np.zeros(0, int), np.zeros(len(node), int)
        owner, arc = np.concatenate(owners), np.concatenate(arcs)
        return arc[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(node))

    def spell(self, arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the arcs, unknown characters as bytes, and where each arc's ids begin."""
        ids = self.ids[arcs]
        unknown = np.flatnonzero(ids < 0)
        code = -1 - ids[unknown].astype(np.int64)
        size = np.ones(len(ids), np.int64)
        size[unknown] += (code > 0x7F).astype(int) + (code > 0x7FF) + (code > 0xFFFF)
        start = np.concatenate(([0], np.cumsum(size)))
        out = np.repeat(ids, size)
        for n, lead in enumerate((0, 0xC0, 0xE0, 0xF0), 1):
            these = size[unknown] == n
            for i in range(n):
                value = code[these] >> (6 * (n - 1 - i))
                out[start[unknown[these]] + i] = self.v.byte_id[value | lead if i == 0 else value & 0x3F | 0x80]
        return out, start


def _uniform(*keys) -> np.ndarray:
    """Numbers inside (0, 1) by hashing keys."""
    h = np.zeros(1, np.uint64)
    for key in keys:
        h = mix((np.asarray(key).astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) ^ h)
    return ((h >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52


def _truncated(location: np.ndarray, ceiling: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbels at ``location`` given that they are below ``ceiling``."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        out = location - np.log(np.exp(location - ceiling) - np.log(u))
    return np.where(np.isfinite(location), np.minimum(out, ceiling), -np.inf)


def sample(lattice: Lattice, keys: np.ndarray, k: int, seed: int = SEED) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to k of (arcs, log probability, perturbed value, inclusion), largest value first."""
    n, first = len(keys), lattice.first
    done: list[list] = [[] for _ in range(n)]
    heap: list[list] = [[] for _ in range(n)]
    text_of = np.repeat(np.arange(n), np.diff(first))
    keys = np.asarray(keys, np.int64)

    def branches(which, arcs, count, logs, base, ceiling, draw):
        """The best k sibling sets that the new places of a path leave: (value, path, place, excluded arcs)."""
        text = np.repeat(np.arange(len(which)), count)
        place = np.arange(len(arcs)) - np.repeat(np.cumsum(count) - count, count)
        location = logs - lattice.log_p[arcs] + lattice.log_rest(arcs)
        value = _truncated(location, ceiling[text], _uniform(seed, keys[which][text], draw, 2 * (place + base[text]) + 1))
        has = np.flatnonzero(count)
        start = (np.cumsum(count) - count)[has]
        for _ in range(k if len(has) else 0):
            top = np.maximum.reduceat(value, start)
            best = np.flatnonzero((value == np.repeat(top, count[has])) & np.isfinite(value))
            best = best[np.unique(text[best], return_index=True)[1]]
            for b, t in zip(best.tolist(), text[best].tolist()):
                heap[which[t]].append((float(value[b]), draw, int(place[b] + base[t]), (int(arcs[b]),)))
            value[best] = -np.inf

    # First path: every part of every text from its start.
    part = lattice.part
    place = np.arange(len(part)) - first[text_of]
    arcs, count = lattice.draw(lattice.begin[part], lattice.end[part], lambda w, s: _uniform(seed, keys[text_of[w]], 0, (place[w] << 20) + 2 * s))
    size = np.add.reduceat(np.append(count, 0), first[:-1]) * (np.diff(first) > 0) if n else np.zeros(0, int)
    logs = np.cumsum(lattice.log_p[arcs])
    edge = np.cumsum(size) - size
    logs -= np.repeat(np.concatenate(([0.0], logs))[edge], size)
    root = -np.log(-np.log(_uniform(seed, keys, -1)))
    paths: list[list] = [[] for _ in range(n)]
    for t in range(n):
        s = slice(edge[t], edge[t] + size[t])
        paths[t].append((arcs[s], logs[s], count[first[t] : first[t + 1]]))
        done[t].append((0, float(root[t])))
    branches(np.arange(n), arcs, size, logs, np.zeros(n, int), root, 0)

    for draw in range(1, k):
        chosen = []
        for t in range(n):
            if heap[t]:
                heap[t].sort(reverse=True)
                chosen.append((t, heap[t].pop(0)))
        if not chosen:
            break
        which = np.array([t for t, _ in chosen])
        nodes, ends, owner, index, prefixes = [], [], [], [], []
        values = np.array([b[0] for _, b in chosen])
        turns, others = _uniform(seed, keys[which], draw, -2), _uniform(seed, keys[which], draw, -3)
        for i, (t, (value, path, at, excluded)) in enumerate(chosen):
            old, old_logs, old_count = paths[t][path]
            node = int(lattice.tail[old[at]])
            options = np.arange(lattice.out[node], lattice.out[node + 1])
            options = options[~np.isin(options, excluded)]
            p = np.exp(lattice.log_p[options])
            arc = int(options[min(np.searchsorted(np.cumsum(p), p.sum() * turns[i]), len(options) - 1)])
            before = float(old_logs[at] - lattice.log_p[old[at]])
            gone = (*excluded, arc)
            left = float(np.exp(lattice.log_p[options[options != arc]]).sum())
            if left > 0:
                location = before + np.log(left)
                heap[t].append((float(_truncated(np.array(location), np.array(value), others[i])), path, at, gone))
            # The part that holds the place, then all parts after it.
            inside = int(np.searchsorted(np.cumsum(old_count), at, side="right"))
            parts = part[first[t] + inside : first[t + 1]]
            begin = lattice.begin[parts].copy()
            begin[0] = lattice.head[arc]
            nodes.append(begin)
            ends.append(lattice.end[parts])
            owner.append(np.full(len(parts), len(prefixes)))
            index.append(np.arange(len(parts)) + inside)
            prefixes.append((old[:at], old_logs[:at], arc, before + float(lattice.log_p[arc]), old_count[:inside], at + 1 - int(old_count[:inside].sum())))
        owner, index = np.concatenate(owner), np.concatenate(index)
        own_keys = keys[which[owner]]
        arcs, count = lattice.draw(np.concatenate(nodes), np.concatenate(ends), lambda w, s: _uniform(seed, own_keys[w], draw, (index[w] << 20) + 2 * s))
        size = np.bincount(owner, count, minlength=len(which)).astype(int)
        edge = np.cumsum(size) - size
        logs = np.cumsum(lattice.log_p[arcs])
        logs += np.repeat(np.array([p[3] for p in prefixes]) - np.concatenate(([0.0], logs))[edge], size)
        per = np.searchsorted(owner, np.arange(len(which) + 1))
        for i, (t, _) in enumerate(chosen):
            a, l, arc, log, counts, taken = prefixes[i]
            s = slice(edge[i], edge[i] + size[i])
            rest = count[per[i] : per[i + 1]].copy()
            rest[0] += taken
            paths[t].append((np.concatenate((a, [arc], arcs[s])), np.concatenate((l, [log], logs[s])), np.concatenate((counts, rest))))
            done[t].append((len(paths[t]) - 1, float(values[i])))
        branches(which, arcs, size, logs, np.array([len(p[0]) + 1 for p in prefixes]), values, draw)

    out = []
    for t in range(n):
        kappa = max((b[0] for b in heap[t]), default=-np.inf)
        rows = []
        for path, value in done[t]:
            a, l, _ = paths[t][path]
            log = float(l[-1]) if len(l) else 0.0
            rows.append((a, log, value, float(-np.expm1(-np.exp(min(log - kappa, 700.0)))) if np.isfinite(kappa) else 1.0))
        out.append(rows)
    return out


def encode_samples(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, seed: int = SEED, model: str = MODEL, sharpness: float = 1.0) -> DataFrame:
    """key, rank (from 1), ids, log_prob, perturbed, inclusion, round_trip (decoding gives the text) for up to k segmentations a row."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model, sharpness))  # as large as the model, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in steps(batches, "text", STEP):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            lattice = Lattice(vocabulary, texts)
            keys = batch.column("key").fill_null(0).to_numpy(zero_copy_only=False)
            rows = [(i, rank, *x) for i, found in enumerate(sample(lattice, keys, k, seed)) for rank, x in enumerate(found, 1)]
            ends = np.concatenate(([0], np.cumsum([len(r[2]) for r in rows])))
            ids, start = lattice.spell(np.concatenate([r[2] for r in rows]) if rows else np.zeros(0, int))
            ends = start[ends]
            decoded, start = vocabulary.bytes_of(ids)
            ok = [decoded[a + 1 : b] == texts[r[0]].encode() for r, a, b in zip(rows, start[ends[:-1]], start[ends[1:]])]
            yield pa.record_batch(
                [batch.column("key").take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.int32()), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)), *(pa.array([r[c] for r in rows], pa.float64()) for c in (3, 4, 5)), pa.array(ok, pa.bool_())],
                names=["key", "rank", "ids", "log_prob", "perturbed", "inclusion", "round_trip"],
            )

    return map_arrow(docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")), run, "key long, rank int, ids array<int>, log_prob double, perturbed double, inclusion double, round_trip boolean")


def decode_ids(rows: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``rows`` with the column decoded; a null list decodes to null."""
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary(model))
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else shared.value.decode(np.array(x, np.int64)).decode(errors="replace") for x in batch.column(ids).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    return map_arrow(rows, run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), "decoded string"]))


def op2_sentencepiece_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two segmentations a text; their ids as a hash, for the digest's sake."""
    found = encode_samples(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("key").alias("doc_id"), "rank", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "inclusion", "round_trip")
