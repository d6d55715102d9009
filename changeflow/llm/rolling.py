"""Array work on Arrow batches of documents: words, rolling hashes, minimisers.

Hashes of spans come from prefix sums, so each costs two look-ups. Seeds and short windows use polynomials over symbols modulo
2**64 (``Spans``). Those are equal for some long patterns of two symbols (a Thue-Morse word and its complement), so contents
are told apart by two polynomials modulo a prime as well (``PrimeSpans``), and words by a sum of mixed (byte, place) pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text worked on at a time; a longer document is worked on alone.
PART_BYTES = 1 << 19

BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE = mix(np.arange(1, 257, dtype=U) * U(BASES[0]))
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def powers(base: int, n: int) -> np.ndarray:
    base %= 1 << 64
    have = _powers.get(base)
    if have is None or len(have) < n:
        factors = np.full(max(n, 2 * PART_BYTES), base, U)
        factors[0] = 1
        _powers[base] = have = np.multiply.accumulate(factors)
    return have[:n]


class Spans:
    """Hashes of spans of a symbol sequence."""

    def __init__(self, symbols: np.ndarray, base: int = BASES[0]):
        n = len(symbols)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(symbols * powers(base, n), out=self.sums[1:])
        self.inverse = powers(pow(base, -1, 1 << 64), n + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] ^ (end - start).astype(U) * U(BASES[1]))

    def grams(self, q: int) -> np.ndarray:
        """Of every span of ``q`` symbols."""
        n = len(self.sums) - q
        if n <= 0:
            return np.zeros(0, U)
        return mix((self.sums[q:] - self.sums[:n]) * self.inverse[:n] ^ U(q * BASES[1] % (1 << 64)))


PRIME = U((1 << 31) - 1)
PRIME_BASES = (1_302_245_537, 948_721_159)
_prime_powers: dict[int, np.ndarray] = {}


def _fold(x: np.ndarray) -> np.ndarray:
    """An equal number modulo the prime, of 32 bits for x below 2**62."""
    return (x & PRIME) + (x >> U(31))


def _prime_power(base: int, n: int) -> np.ndarray:
    have = _prime_powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, U)
        while len(have) < max(n, 2 * PART_BYTES):
            have = np.concatenate([have, _least(have * U(pow(base, len(have), int(PRIME))))])
        _prime_powers[base] = have
    return have[:n]


def _least(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(x))
    return np.where(x >= PRIME, x - PRIME, x)


class PrimeSpans:
    """62-bit hashes of spans: polynomials with two bases modulo 2**31 - 1, over two parts of each 64-bit symbol."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.sums, self.inverses = [], []
        for base, part in zip(PRIME_BASES, (symbols >> U(33), symbols & PRIME), strict=True):
            total = np.zeros(n + 1, U)
            np.cumsum(_fold(part * _prime_power(base, n)), out=total[1:])
            self.sums.append(total)
            self.inverses.append(_prime_power(pow(base, -1, int(PRIME)), n + 1))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        one, two = (_least(_fold(s[end] - s[start]) * v[start]) for s, v in zip(self.sums, self.inverses, strict=True))
        return (one << U(31)) | two


def text_parts(batch: pa.RecordBatch, column: str = "text", part_bytes: int = PART_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows: first row, end, their bytes, and where each row starts in them (one more at the end)."""
    col = batch.column(batch.schema.names.index(column))
    if pa.types.is_dictionary(col.type):
        col = col.dictionary_decode()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if len(col) == 0:
        return
    offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + part_bytes, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and how many words lie before each row (one more at the end)."""
    n = len(data)
    solid = ~_BLANK[data]
    first = np.zeros(n + 1, bool)
    first[at] = True
    edge = first[:n].copy()
    edge[1:] |= ~solid[:-1]
    starts = np.flatnonzero(solid & edge)
    last = first[1:].copy()
    last[:-1] |= ~solid[1:]
    ends = np.flatnonzero(solid & last) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_symbols(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: its length and the sum of mixed (byte, place) pairs."""
    if not len(starts):
        return np.zeros(0, U)
    n = ends - starts
    inside = np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    place = (inside - np.repeat(starts, n)).astype(U)
    total = np.zeros(len(inside) + 1, U)
    np.cumsum(mix(BYTE[data[inside]] + place * U(BASES[1])), out=total[1:])
    edge = np.concatenate([[0], np.cumsum(n)])
    return mix((total[edge[1:]] - total[edge[:-1]]) ^ n.astype(U) * U(BASES[0]))


def first_minimum(v: np.ndarray, w: int) -> np.ndarray:
    """For every run of ``w`` values the place of its smallest, the leftmost if there are ties."""
    if len(v) < w:
        return np.zeros(0, np.int64)
    least, place, size = v, np.arange(len(v)), 1
    while 2 * size <= w:
        keep = least[:-size] <= least[size:]
        place = np.where(keep, place[:-size], place[size:])
        least = np.where(keep, least[:-size], least[size:])
        size *= 2
    if size < w:
        n = len(v) - w + 1
        keep = least[:n] <= least[w - size : w - size + n]
        place = np.where(keep, place[:n], place[w - size : w - size + n])
    return place


def anchors(grams: np.ndarray, at: np.ndarray, window: int, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing: every window of ``window`` symbols inside one row has the smallest of its q-grams as anchor, so equal
    windows have equal anchors at equal offsets. Returns row, anchor, first and last window start of each anchor."""
    place = first_minimum(grams, window - q + 1)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(place)]
    inside = np.flatnonzero(np.arange(len(place)) + window <= at[1:][row])
    place = place[inside]
    new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, np.int64)
    last = np.r_[new[1:], len(place)][: len(new)] - 1
    return row[inside[new]], place[new], inside[new], inside[last]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
