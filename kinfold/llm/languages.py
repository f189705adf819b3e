"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read as UTF-8 in segments of ``SEGMENT`` bytes, each from a zero state, once forward and once backward.
Gates and candidates saturate by
``x / (1 + |x|)``, which costs a fraction of exponentials. At every byte the two states give a distribution over the languages; a text's probabilities are the means of those at its
letters (ASCII letters and bytes from 0x80 on). So each byte of a text of any length is labelled once.

The network is trained in numpy on the driver, by backpropagation through time with Adam, on the position labels of
segments: of each of the ``LANGUAGES`` most frequent languages about ``SAMPLE`` distinct texts, those with the smallest text
hashes, give ``PIECES`` segments each, from places spread over the whole text. These bounds are the only ones; every row is
predicted, in one narrow pass. Only text and lang of rows whose crc32(doc_id) modulo 4 isn't 2 are learned from.

Defined results: null texts and texts without a letter are ``und`` with score 0; a null doc_id is not held out and not
learned from; a null lang is not learned from; ties go to the first language in UTF-8 order; with nothing to learn from
every text is ``und``; with one language all texts with letters have it, with score 1; repeated rows are predicted each; an
empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.text import steps
from kinfold.workers import map_arrow

SEGMENT = 128
HIDDEN = 8
LANGUAGES = 64
SAMPLE = 400
PIECES = 3
UPDATES = 240
BATCH = 192
RATE = 0.02
#: Segments that run side by side in prediction.
LANES = 2048
#: The symbol behind the end of a segment: it leaves the state as it is.
PAD = 256
FOLDS, HELD_OUT = 4, 2

_LETTER = np.zeros(PAD + 1, np.float32)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


@dataclass
class Direction:
    """One gated recurrent layer: gates in the order update, reset, candidate."""

    enter: np.ndarray  # 3H x 257, what each byte adds; biases are part of it
    turn: np.ndarray  # 3H x H, what the state adds
    inner: np.ndarray  # H x 1, bias inside the reset gate's product


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # languages x 2H
    bias: np.ndarray  # languages x 1

    def parameters(self) -> list[np.ndarray]:
        return [*(getattr(d, f) for d in (self.forward, self.backward) for f in ("enter", "turn", "inner")), self.out, self.bias]


def start(languages: list[str], hidden: int = HIDDEN, seed: int = 0) -> Network:
    r = np.random.default_rng(seed)
    near = lambda *shape, scale: (r.normal(size=shape) * scale).astype(np.float32)

    def direction() -> Direction:
        d = Direction(near(3 * hidden, PAD + 1, scale=0.5), near(3 * hidden, hidden, scale=hidden**-0.5), np.zeros((hidden, 1), np.float32))
        d.enter[:hidden] += 1.0  # states last at first
        return d

    return Network(languages, direction(), direction(), near(len(languages), 2 * hidden, scale=0.3), np.zeros((len(languages), 1), np.float32))


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _step(d: Direction, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """(update, reset, candidate, the candidate's part of the state, new state) of one byte in every lane."""
    n = len(h)
    a, g = d.enter[:, x], d.turn @ h
    gates = _soft(a[: 2 * n] + g[: 2 * n]) * np.float32(0.5) + np.float32(0.5)
    inner = g[2 * n :] + d.inner
    gates[:n][:, x == PAD] = 1
    candidate = _soft(a[2 * n :] + gates[n:] * inner)
    return gates[:n], gates[n:], candidate, inner, candidate + gates[:n] * (h - candidate)


def gradient(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy of the labels of letters, and its gradient for every parameter. x: steps x lanes; y: a language a lane."""
    steps_, lanes = x.shape
    h = net.out.shape[1] // 2
    runs = []
    for d, order in ((net.forward, range(steps_)), (net.backward, range(steps_ - 1, -1, -1))):
        state, kept = np.zeros((h, lanes), d.enter.dtype), {}
        for t in order:
            kept[t] = (state, *_step(d, x[t], state))
            state = kept[t][-1]
        runs.append((d, order, kept))
    states = np.stack([np.concatenate([kept[t][-1] for _, _, kept in runs]) for t in range(steps_)])  # T x 2H x B
    logits = net.out @ states + net.bias
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    weight = _LETTER[x].astype(p.dtype)
    weight /= max(weight.sum(), 1)
    mine = p[:, y, np.arange(lanes)]
    loss = -float((np.log(np.maximum(mine, 1e-30)) * weight).sum())
    p[:, y, np.arange(lanes)] -= 1
    p *= weight[:, None, :]
    d_out, d_bias = np.einsum("tlb,thb->lh", p, states, optimize=True), p.sum(axis=(0, 2))[:, None]
    d_states = net.out.T @ p
    grads = []
    for k, (d, order, kept) in enumerate(runs):
        d_turn, d_inner = np.zeros_like(d.turn), np.zeros_like(d.inner)
        d_gates = np.zeros((steps_, 3 * h, lanes), d.enter.dtype)
        back = np.zeros((h, lanes), d.enter.dtype)
        for t in reversed(order):
            before, z, r, n, inner, _ = kept[t]
            dh = back + d_states[t, k * h : (k + 1) * h]
            # The slope of x / (1 + |x|) is (1 - |y|)**2.
            dn = dh * (1 - z) * (1 - np.abs(n)) ** 2
            dz = dh * (before - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            dr = dn * inner * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            d_gates[t, :h], d_gates[t, h : 2 * h], d_gates[t, 2 * h :] = dz, dr, dn
            through = np.concatenate((dz, dr, dn * r))
            d_turn += through @ before.T
            d_inner += (dn * r).sum(axis=1, keepdims=True)
            back = dh * z + d.turn.T @ through
        flat, seen = d_gates.transpose(1, 0, 2).reshape(3 * h, -1), x.ravel()
        d_enter = np.stack([np.bincount(seen, row, PAD + 1) for row in flat]).astype(d.enter.dtype)
        grads += [d_enter, d_turn, d_inner]
    return loss, [*grads, d_out, d_bias]


def segments(data: np.ndarray, bounds: np.ndarray, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first byte, length) of the segments of texts that lie one after the other in ``data``, longest first."""
    pieces = -(-np.diff(bounds) // size)
    text = np.repeat(np.arange(len(pieces)), pieces)
    place = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = bounds[text] + place * size
    length = np.minimum(size, bounds[text + 1] - first)
    order = np.argsort(-length, kind="stable")
    return text[order], first[order], length[order]


def lanes_of(data: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Segments side by side: steps x lanes of bytes, PAD behind an end."""
    t = np.arange(length.max())[:, None]
    inside = t < length
    return np.where(inside, data[np.where(inside, first + t, 0)].astype(np.intp), PAD)


def _states(d: Direction, x: np.ndarray, order: range, take) -> None:
    """Run a layer over the lanes and hand each state on; without what training keeps."""
    h, lanes = d.turn.shape[1], x.shape[1]
    enter = d.enter.copy()
    enter[:h, PAD] = 1e30  # the update gate is 1 there, so that the state stays
    state, half, one = np.zeros((h, lanes), np.float32), np.float32(0.5), np.float32(1)
    a, g, size = (np.empty((3 * h, lanes), np.float32) for _ in range(3))
    gates, size_of_gates, candidate, inner = a[: 2 * h], size[: 2 * h], a[2 * h :], g[2 * h :]
    for t in order:
        np.take(enter, x[t], axis=1, out=a, mode="clip")
        np.matmul(d.turn, state, out=g)
        gates += g[: 2 * h]
        np.abs(gates, out=size_of_gates)
        size_of_gates += one
        gates /= size_of_gates
        gates *= half
        gates += half
        inner += d.inner
        inner *= gates[h:]
        candidate += inner
        np.abs(candidate, out=size[2 * h :])
        size[2 * h :] += one
        candidate /= size[2 * h :]
        state -= candidate
        state *= gates[:h]
        state += candidate
        take(t, state)


def probabilities(net: Network, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Texts x languages; rows of texts without letters are 0."""
    total, letters = np.zeros((len(bounds) - 1, len(net.languages))), np.zeros(len(bounds) - 1)
    text, first, length = segments(data, bounds)
    h = net.out.shape[1] // 2
    for at in range(0, len(text), LANES):
        own, x = text[at : at + LANES], lanes_of(data, first[at : at + LANES], length[at : at + LANES])
        weight = _LETTER[x]
        logits = np.empty((len(x), len(net.languages), x.shape[1]), np.float32)
        pooled = np.zeros((len(net.languages), x.shape[1]), np.float32)

        def ahead(t: int, state: np.ndarray) -> None:
            np.matmul(net.out[:, :h], state, out=logits[t])

        def back(t: int, state: np.ndarray) -> None:
            p = net.out[:, h:] @ state
            p += logits[t]
            p += net.bias
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p *= weight[t] / p.sum(axis=0)
            np.add(pooled, p, out=pooled)

        _states(net.forward, x, range(len(x)), ahead)
        _states(net.backward, x, range(len(x) - 1, -1, -1), back)
        np.add.at(total, own, pooled.T.astype(float))
        np.add.at(letters, own, weight.sum(axis=0))
    return total / np.maximum(letters, 1)[:, None]


def train(samples: dict[str, list[bytes]], updates: int = UPDATES, seed: int = 0) -> Network:
    """A network for the languages of the samples, each drawn from as often as any other."""
    net = start(sorted(samples), seed=seed)
    if len(samples) < 2:
        return net
    r = np.random.default_rng(seed)
    pool = [samples[name] for name in net.languages]
    values = net.parameters()
    one, two = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for i in range(1, updates + 1):
        y = r.integers(0, len(pool), BATCH)
        chosen = [pool[k][r.integers(len(pool[k]))] for k in y]
        bounds = np.concatenate(([0], np.cumsum([len(c) for c in chosen])))
        x = lanes_of(np.frombuffer(b"".join(chosen), np.uint8), bounds[:-1], np.diff(bounds))
        _, grads = gradient(net, x, y)
        norm = float(np.sqrt(sum((g.astype(float) ** 2).sum() for g in grads)))
        rate = RATE * (1 - (i - 1) / updates) * min(1.0, 1.0 / max(norm, 1e-9))
        scale = np.float32(rate * np.sqrt(1 - 0.99**i) / (1 - 0.9**i)) if norm else np.float32(0)
        for v, g, m, s in zip(values, grads, one, two):
            g = g * np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
            m += np.float32(0.1) * (g - m)
            s += np.float32(0.01) * (g * g - s)
            v -= scale * m / (np.sqrt(s) + np.float32(1e-8))
    return net


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def sample(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", size: int = SAMPLE, languages: int = LANGUAGES) -> dict[str, list[bytes]]:
    """Segments of about ``size`` distinct texts of each of the most frequent languages; a bounded number of bytes."""
    known = docs.where((fold(F.col(doc_id)) != HELD_OUT) & F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("text IS NOT NULL")
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(languages).collect()
    if not counts:
        return {}
    # A threshold on the text's hash thins the table before anything is sorted; copies are in or out together.
    share = F.create_map(*[F.lit(v) for c in counts for v in (c.lang, min(1.0, 3.0 * size / c.n))])
    h = F.xxhash64("text", F.lit("sample"))
    drawn = known.withColumn("h", h).where(F.pmod("h", F.lit(1 << 30)) < F.coalesce(share[F.col("lang")], F.lit(0.0)) * (1 << 30)).where(F.col("text").rlike("\\p{L}"))
    # Places spread over the whole text; only these pieces are moved.
    place = lambda i: F.floor(F.greatest(F.length("text") - SEGMENT, F.lit(0)) * (i / max(PIECES - 1, 1))).cast("int") + 1
    drawn = drawn.select("lang", "h", F.array_distinct(F.array(*[F.substring("text", place(i), F.lit(SEGMENT)) for i in range(PIECES)])).alias("pieces"))
    once = drawn.groupBy("lang", "h").agg(F.min("pieces").alias("pieces"))
    from pyspark.sql import Window

    ranked = once.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h"))).where(F.col("r") <= size)
    out: dict[str, list[bytes]] = {}
    for row in ranked.select("lang", "h", "pieces").orderBy("lang", "h").collect():
        for piece in row.pieces:
            data = piece.encode()[:SEGMENT]
            if any(_LETTER[b] for b in data):
                out.setdefault(row.lang, []).append(data)
    return out


def identify(docs: DataFrame, net: Network, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    kind = docs.schema[doc_id].dataType.simpleString()
    names = pa.array([*net.languages, "und"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            raw = texts.buffers()[2]
            data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
            p = probabilities(net, data, offsets - offsets[0]) if net.languages else np.zeros((len(texts), 0))
            best = p.argmax(axis=1) if net.languages else np.zeros(len(texts), int)
            none = ~batch.column("letter").to_numpy(zero_copy_only=False).astype(bool) if net.languages else np.ones(len(texts), bool)
            score = np.where(none, 0.0, np.clip(p[np.arange(len(p)), best] if net.languages else 0.0, 0, 1))
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), names.take(pa.array(np.where(none, len(net.languages), best))), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    out = F.coalesce(fold(F.col(doc_id)) == HELD_OUT, F.lit(False))
    rows = docs.select(F.col(doc_id).alias("doc_id"), out.alias("held_out"), F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)).alias("letter"), F.col(text).alias("text"))
    return map_arrow(rows, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, train(sample(docs)))
