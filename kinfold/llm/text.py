"""Word and line splitting shared by the text operators.

A word is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = "[^\\x20\\x09-\\x0D]+"
GAP = "[\\x20\\x09-\\x0D]+"

#: Bytes of text that one Python step holds at a time; a longer text is a step of its own.
STEP_BYTES = 1_000_000

#: Bytes from which a word's hash is not the polynomial's.
LONG_WORD = 64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words(text: Column) -> Column:
    """The words of a text; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), F.array().cast("array<string>"))


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A to Z in lower case."""
    return _LOWER[data]


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: every bit of the input reaches every bit of the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.back = int(base), pow(int(base), -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.back)):
                step = np.full(size, base, np.uint64)
                step[0] = 1
                setattr(self, name, np.multiply.accumulate(step))
        return self.up, self.down


class PrimePowers(Powers):
    """Powers of a primitive root modulo 2**31 - 1 and of its inverse."""

    def __init__(self, base: int):
        self.base, self.back = base, pow(base, -1, int(_PRIME))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            for name, base in (("up", self.base), ("down", self.back)):
                now = getattr(self, name)
                setattr(self, name, np.concatenate((now, now * np.uint64(pow(base, size, int(_PRIME))) % _PRIME)))
        return self.up, self.down


_PRIME = np.uint64(2**31 - 1)
_powers = {1: Powers(_B1), 3: Powers(_B2)}
_prime_powers = PrimePowers(16807), PrimePowers(48271)


class Rolling:
    """Hashes of any slice of a sequence of integers in constant time.

    ``which`` 1 and 3 are polynomials modulo 2**64, which sequences of much structure (Thue and Morse's, from about 256
    values on) can make collide whatever the base; ``which`` 2 has two polynomials modulo the prime 2**31 - 1
    beside each other, which they can't. What must not collide is told apart by both kinds.
    """

    def __new__(cls, values: np.ndarray, which: int = 1):
        return super().__new__(_PrimeRolling if which == 2 else cls)

    def __init__(self, values: np.ndarray, which: int = 1):
        self.up, self.down = _powers[which].upto(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.multiply(values, self.up[: len(values)], out=self.sums[1:])
        self.sums[1:] += self.up[: len(values)]
        np.cumsum(self.sums[1:], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The length takes part, so that slices of different lengths differ."""
        return mix((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64))


class _PrimeRolling(Rolling):
    def __init__(self, values: np.ndarray, which: int = 2):
        values = mix(values)
        halves = values % _PRIME, (values >> np.uint64(32)) % _PRIME
        self.sides = []
        for half, powers in zip(halves, _prime_powers):
            up, down = powers.upto(len(values) + 1)
            self.sides.append((np.concatenate((np.zeros(1, np.uint64), np.cumsum((half + np.uint64(1)) * up[: len(half)] % _PRIME))), down))

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        one, two = ((sums[stop] - sums[start]) % _PRIME * down[start] % _PRIME for sums, down in self.sides)
        return mix((one << np.uint64(31) | two) + (stop - start).astype(np.uint64) * _B2)


class Batch:
    """The words of some texts as offsets into one buffer of UTF-8.

    ``start`` and ``stop`` bound each word in ``data``; words ``first[i]`` to
    ``first[i + 1]`` are those of text i.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("") if texts.null_count else texts
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        self.bounds = offsets - offsets[0]
        inside = ~_SPACE[self.data]
        begins, ends = inside.copy(), inside.copy()
        if len(inside):
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            # A text's edge also ends a word.
            edges = self.bounds[1:-1]
            edges = edges[(edges > 0) & (edges < len(inside))]
            begins[edges] = inside[edges]
            ends[edges - 1] = inside[edges - 1]
        self.start, self.stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.bounds)

    def word_hashes(self, which: int = 1) -> np.ndarray:
        """``which`` is 1 or 3; words of more than LONG_WORD bytes are hashed by XXH64, for polynomials are weak on them."""
        import xxhash

        found = Rolling(self.data, which).of(self.start, self.stop)
        for i in np.flatnonzero(self.stop - self.start > LONG_WORD).tolist():
            found[i] = xxhash.xxh64_intdigest(self.data[self.start[i] : self.stop[i]].tobytes(), which)
        return found


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores added where a column has one of them (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def steps(batches: Iterator[pa.RecordBatch], text: str, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that no step holds much more than ``size`` bytes of text."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        before = np.cumsum(sizes) // size
        cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
