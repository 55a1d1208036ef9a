"""Vectorised hashing of the bytes, words and shingles of Arrow text columns.

All functions work on whole texts as UTF-8 bytes and need a few dozen bytes of memory per byte of one segment, not of
the whole batch: long batches are cut into segments at white space or handled in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64; kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, SEGMENT + 1), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[int(base)] = have
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and the n + 1 offsets; null counts as empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """n + 1 running sums; ``span_hash`` gets the hash of any span from two of them."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(BASE, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hashes of the spans [start, end)."""
    return mix((prefix[end] - prefix[start]) * powers(INVERSE, len(prefix))[start])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, and where each text's words begin (n + 1)."""
    n = len(data)
    space = SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    inner = ~space
    starts = np.flatnonzero(inner & (edge[:-1] | np.concatenate([[True], space[:-1]]))) if n else np.zeros(0, np.int64)
    ends = (np.flatnonzero(inner & (edge[1:] | np.concatenate([space[1:], [True]]))) + 1) if n else starts
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        stop = int(np.searchsorted(starts, starts[at] + SEGMENT))
        lo, hi = int(starts[at]), int(ends[stop - 1])
        prefix = prefix_hash(LOWER[data[lo:hi]])
        hashes[at:stop] = span_hash(prefix, starts[at:stop] - lo, ends[at:stop] - lo)
        at = stop
    return hashes, np.searchsorted(starts, offsets)


def shingles(word: np.ndarray, width: int = 5) -> np.ndarray:
    """Distinct shingle hashes of one text, ascending; fewer words than ``width`` make one shingle, none makes none."""
    if not len(word):
        return np.zeros(0, np.uint64)
    width = min(width, len(word))
    scale = powers(BASE, width)
    total = np.full(len(word) - width + 1, np.uint64(width * 0xD6E8FEB86659FD93 % (1 << 64)), np.uint64)
    for i in range(width):
        total += word[i : len(word) - width + 1 + i] * scale[i]
    return np.unique(mix(total))


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """The set of every text of a column, in order; few texts at a time, so memory stays small."""
    at, n = 0, len(column)
    sizes = np.diff(text_bytes(column)[1])
    while at < n:
        stop, total = at + 1, sizes[at]
        while stop < n and total + sizes[stop] <= SEGMENT:
            total += sizes[stop]
            stop += 1
        word, first = words(*text_bytes(column.slice(at, stop - at)))
        for i in range(stop - at):
            yield shingles(word[first[i] : first[i + 1]], width)
        at = stop
