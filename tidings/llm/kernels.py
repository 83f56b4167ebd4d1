"""Array kernels over whole Arrow batches of texts: words, hashes of byte ranges, ragged gathers.

A batch is worked through in blocks of whole documents, so that memory follows the block (or the
longest document), never the batch. Hashes are 64-bit polynomials of randomised bytes followed by
a bit mixer; they are the same in every process and on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

_GOLDEN = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed odd numbers that look random."""
    start = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 20)) * np.uint64(_GOLDEN)
    return mix(start) | np.uint64(1)


_CODES = seeds(256, 7)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


class _Powers:
    """Powers of the base and of its inverse, grown on demand and kept per process."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, BLOCK_BYTES + 1)
            cls.up, cls.down = (_powers(base, size) for base in (_BASE, _BASE_INVERSE))
        return cls.up, cls.down


class RangeHash:
    """Hashes of any byte ranges of one block, each in constant time."""

    def __init__(self, data: np.ndarray):
        up, self._down = _Powers.of(len(data) + 1)
        self._sums = np.empty(len(data) + 1, np.uint64)
        self._sums[0] = 0
        np.cumsum(_CODES[data] * up[: len(data)], out=self._sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._sums[end] - self._sums[begin]) * self._down[begin]
        return mix(raw + (end - begin).astype(np.uint64) * np.uint64(_GOLDEN))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)), bounds


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of whole texts: first row, row after the last, bytes, offsets from 0."""
    data, bounds = text_buffers(column)
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def spans(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every run of bytes of one class other than 0, none across a text's end; how
    many each text has."""
    n = len(inside)
    if n == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(bounds) - 1, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    new = cut[1:n] | (inside[1:] != inside[:-1])
    begins, ends = inside != 0, inside != 0
    begins[1:] &= new
    ends[:-1] &= new
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return begin, end, np.diff(np.searchsorted(begin, bounds))


def byte_class(members: str | bytes, inverse: bool = False) -> np.ndarray:
    """A table that says of each byte whether it belongs to ``members``."""
    table = np.zeros(256, bool)
    table[np.frombuffer(members if isinstance(members, bytes) else members.encode("latin-1"), np.uint8)] = True
    return ~table if inverse else table


#: Bytes of words that white space separates: all but U+0020 and U+0009 to U+000D.
SPACED = byte_class(b" \t\n\x0b\x0c\r", inverse=True)
#: Bytes of words of letters and digits: 0-9, a-z and everything beyond ASCII (texts are lower-cased first).
ALNUM = byte_class(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
#: Words of letters and digits (either case) as class 1, runs of other marks as class 2.
TEXT_AND_MARKS = np.where(SPACED, 2, 0).astype(np.uint8)
TEXT_AND_MARKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Words:
    """The words of one block: byte ranges, 64-bit hashes, and how many each text has."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, inside: np.ndarray, lower: bool = True):
        data = LOWER[data] if lower else data
        self.begin, self.end, self.counts = spans(inside[data], bounds)
        self.hashes = RangeHash(data)(self.begin, self.end)
        self.firsts = np.concatenate([[0], np.cumsum(self.counts)])
        self.texts = np.repeat(np.arange(len(self.counts)), self.counts)


def grams(hashes: np.ndarray, n: int, salt: int) -> np.ndarray:
    """The hash of every ``n`` consecutive numbers (of one block: texts are not kept apart)."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i, factor in enumerate(seeds(n, salt)):
        out += mix(hashes[i : len(hashes) - n + 1 + i] ^ factor) * factor
    return mix(out)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of ``lengths[i]`` consecutive places from each ``starts[i]`` on."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as the 64-bit numbers that Spark has."""
    return x.view(np.int64)
