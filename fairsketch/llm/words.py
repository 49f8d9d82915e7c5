"""Words, word fingerprints and word n-grams of Arrow text columns, vectorised with NumPy.

Operators call :func:`texts` inside an Arrow task.  It cuts a text column into slices of about
one megabyte (a longer text is a slice of its own, so every text stays whole) and gives each
slice as a :class:`Text`.  A null text is an empty text.  Nothing here knows about Spark.

Fingerprints are 64-bit polynomial hashes over bytes or words, read from prefix sums, so any
span's fingerprint costs one subtraction and one multiplication.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_pow = np.ones(1, U64)
_inv = np.ones(1, U64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (a bijection), so that their high bits can choose buckets."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_CODES = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    global _pow, _inv
    if len(_pow) < n:
        size = 1 << (n - 1).bit_length()
        steps = np.full(size, U64(_BASE))
        back = np.full(size, U64(pow(_BASE, -1, 1 << 64)))
        steps[0] = back[0] = U64(1)
        _pow, _inv = np.multiply.accumulate(steps), np.multiply.accumulate(back)
    return _pow, _inv


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes in the given inclusive ranges."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


#: Word bytes of `[^\x20\x09-\x0D]+` and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
SPACED = ~byte_table((0x20, 0x20), (0x09, 0x0D))
LETTERS_DIGITS = byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def prefix_sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values, out=out[1:])
    return out


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]] for each i; empty ranges give 0."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


class Text:
    """Consecutive texts as one byte array.

    ``offsets``: byte limits of the texts; ``starts``/``ends``: byte limits of the words;
    ``first``: word limits of the texts (text i has the words first[i]..first[i+1]-1);
    ``doc``: each word's text.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        self.n = len(offsets) - 1
        inside = table[self.data]
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        edges = offsets[1:-1]
        before[edges[edges < len(inside)]] = False
        after[edges[edges > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n), self.counts)
        self._bytes = None

    def spans(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Fingerprints of the byte spans [a, b)."""
        pw, inv = _powers(len(self.data) + 1)
        if self._bytes is None:
            self._bytes = prefix_sums(_CODES[self.data] * pw[:len(self.data)])
        return mix((self._bytes[b] - self._bytes[a]) * inv[a])

    def hashes(self) -> np.ndarray:
        """A fingerprint of each word."""
        return self.spans(self.starts, self.ends)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def grams(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, fingerprints) of all k-word windows that lie within one text."""
        if len(hashes) < k:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        at = np.arange(len(hashes) - k + 1)
        at = at[at + k <= self.first[self.doc[at] + 1]]
        return at, sequence(word_sums(hashes), at, at + k)


def word_sums(hashes: np.ndarray) -> np.ndarray:
    pw, _ = _powers(len(hashes) + 1)
    return prefix_sums(hashes * pw[:len(hashes)])


def sequence(total: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprints of the word sequences [a, b), from :func:`word_sums`."""
    return mix((total[b] - total[a]) * _powers(len(total))[1][a])


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums over bytes, for :func:`sequence` and :func:`windows`."""
    return word_sums(_CODES[data])


def windows(total: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of all k long spans, in order (scrambled less than :func:`sequence`, for use as keys)."""
    out = total[k:] - total[:len(total) - k]
    out *= _powers(len(total))[1][:len(out)]
    out ^= out >> U64(32)
    out *= U64(0x94D049BB133111EB)
    out ^= out >> U64(29)
    return out


def covered(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """True for the places of 0..n-1 inside one of the spans [a, b)."""
    step = np.bincount(a, minlength=n + 1)[:n + 1] - np.bincount(b, minlength=n + 1)[:n + 1]
    return np.cumsum(step)[:n] > 0


def string_column(col) -> pa.Array:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks)
    return col.cast(pa.large_string()).fill_null("")


def buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty."""
    col = string_column(col)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def texts(col, table: np.ndarray = SPACED, lower: bool = False,
          slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, Text]]:
    """(lo, hi, Text of the rows lo..hi-1) over a string column, in order."""
    if len(col) == 0:
        return
    data, offsets = buffers(col)
    lo = 0
    while lo < len(offsets) - 1:
        hi = int(np.searchsorted(offsets, offsets[lo] + slice_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), len(offsets) - 1)
        yield lo, hi, Text(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], table, lower)
        lo = hi


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, limits): keys[order] is sorted, and limits cut it into runs of equal keys."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    cut = np.flatnonzero(s[1:] != s[:-1]) + 1 if len(s) else np.zeros(0, np.int64)
    return order, np.concatenate([[0], cut, [len(s)]]) if len(s) else np.zeros(1, np.int64)
