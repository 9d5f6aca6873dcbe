"""Vectorised words, hashes and windows over blocks of texts.

A block is a run of documents whose UTF-8 bytes lie one behind the other, as in an Arrow
string column. Everything works on whole texts; a block only bounds the memory in use.
Words are maximal runs of bytes outside ``\\x20\\x09-\\x0D``, or of those that a given table marks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once (one document may exceed it).
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240607).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C17  # odd; its powers weigh the bytes of a word
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (splitmix finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows [first, last) with their bytes and offsets, each of about ``limit`` bytes."""
    data, offsets = text_bytes(column)
    rows = len(offsets) - 1
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Words:
    """Words of a block: byte starts and ends, and ``bounds``, the word offsets per document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, letters: np.ndarray | None = None):
        inside = ~_SPACE[data] if letters is None else letters[data]
        starts, ends = inside.copy(), inside.copy()
        if len(data):
            starts[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            full = offsets[1:] > offsets[:-1]
            edge = offsets[:-1][full]
            starts[edge] = inside[edge]
            edge = offsets[1:][full] - 1
            ends[edge] = inside[edge]
        self.data, self.offsets, self.inside = data, offsets, inside
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of every word; ``lower`` folds A-Z first."""
        return span_hashes(_LOWER[self.data] if lower else self.data, self.starts, self.ends)


def byte_values(data: np.ndarray) -> np.ndarray:
    """A 64-bit value for every byte."""
    return _RANDOM[data]


class Prefix:
    """Prefix sums of a sequence of 64-bit values: the hash of any span in constant time."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers(_BASE, len(values)), out=self.sums[1:])
        self.inverse = _powers(_INVERSE, len(values) + 1)

    def hash(self, starts, ends) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes [start, end) of every span."""
    return Prefix(byte_values(data)).hash(starts, ends)


def per_document(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set in each [bounds[i], bounds[i + 1])."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def cover(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n positions some [start, start + width) holds."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return np.cumsum(steps[:n]) > 0


def owners(bounds: np.ndarray) -> np.ndarray:
    """The document of every position."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether it occurs twice or more, and whether an earlier one equals it."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    later[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, later


_KEPT: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept for blocks of the usual size."""
    kept = _KEPT.get(base)
    if kept is not None and len(kept) >= n:
        return kept[:n]
    size = max(n, BLOCK_BYTES + (1 << 16))
    out = np.ones(size, np.uint64)
    filled = 1
    while filled < size:
        step = min(filled, size - filled)
        out[filled : filled + step] = out[:step] * np.uint64(pow(base, filled, 1 << 64))
        filled += step
    if size <= 4 * BLOCK_BYTES:
        _KEPT[base] = out
    return out[:n]


def _weights(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def windows(hashes: np.ndarray, width: int, seed: int = 7) -> np.ndarray:
    """Hash of every ``width`` consecutive values; index i covers [i, i + width)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, weight in enumerate(_weights(width, seed)):
        out += hashes[j : j + n] * weight
    return mix(out)


def shingle_sets(words: Words, width: int = 5, lower: bool = True) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its ``width``-word shingles.

    A document of fewer words has its whole sequence as one shingle; one without words none.
    """
    hashed = words.hashes(lower)
    all_windows = windows(hashed, width)
    weights = _weights(width, 7)
    out = []
    for first, last in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if last - first >= width:
            out.append(distinct(all_windows[first : last - width + 1]))
        elif last > first:
            n = last - first
            short = (hashed[first:last] * weights[:n]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(short ^ np.uint64(0xA5A5A5A5 + n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    if len(values) < 2:
        return values
    keep = np.empty(len(values), bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]
