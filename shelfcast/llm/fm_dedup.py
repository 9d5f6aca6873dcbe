"""Removes repeated word windows with compressed FM-indexes, one per shard.

Every word covered by a window of ``WIDTH`` words whose sequence also starts earlier (smaller id,
or earlier in the same document) goes; windows are judged on the input.

Windows that may repeat are found by content-defined anchors (see ``anchors``), and only pieces
whose anchor gram has several different surroundings are indexed. A shard keeps its distinct
pieces, in the order of their first occurrence, as an FM-index: the Burrows-Wheeler transform in a
wavelet matrix of packed bits with block counts. The pieces stream through it: backward search
extends every window to the left, one word a step, and drops a window once nothing but itself
matches. What reaches the full width has a matching statistic above the threshold; the interval's
first piece tells whether the match starts earlier. A gram with more occurrences than a shard is
settled by the first piece of each group of equal windows instead.

Defined results: a null or empty text has no words; documents of fewer than ``WIDTH`` words keep
all; rows with one id and one text are the same occurrence, neither earlier; rows of one id with
different texts follow the order of their texts' md5; a null id sorts before all others; further columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import anchors, blocks
from shelfcast.llm.tables import shuffle_width, stored

WIDTH, GRAM = 20, 6
#: Occurrences per shard of pieces, about, and the most of one gram.
SHARD = 60_000

_PACKED = (
    "shard int, gram array<long>, piece array<long>, doc array<long>, at array<long>, "
    "size array<int>, words array<long>"
)
_RESOLVED = "gram long, piece long, first_doc long, ranges array<int>"


class Bits:
    """A bit vector, packed, that counts set bits before any position."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self._words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self._words).astype(np.int64)
        self._before = np.concatenate([[0], np.cumsum(counts)[:-1]])

    def rank(self, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self._before[block] + np.bitwise_count(self._words[block] & below)


class WaveletMatrix:
    """Counts of a symbol before any position of a sequence, in one bit vector per bit."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self._levels = []
        current = symbols
        for shift in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            bits = ((current >> shift) & 1).astype(bool)
            zeros = int(len(bits) - bits.sum())
            self._levels.append((shift, Bits(bits), zeros))
            current = np.concatenate([current[~bits], current[bits]])
        self._start = self._walk(np.arange(alphabet), np.zeros(alphabet, np.int64))

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self._levels:
            ones = bits.rank(at)
            at = np.where((symbols >> shift) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._walk(symbols, at) - self._start[symbols]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a sequence in the order of their first ``depth`` symbols, by doubling ranks."""
    rank = text.astype(np.int64)
    known = 1
    while known < depth:
        after = np.zeros(len(rank), np.int64)
        after[: len(rank) - known] = rank[known:] + 1
        pairs = rank * (int(rank.max(initial=0)) + 2) + after
        rank = np.unique(pairs, return_inverse=True)[1]
        known *= 2
    return np.argsort(rank, kind="stable")


class FMIndex:
    """Backward search over a sequence of symbols; 0 parts its pieces and is never searched."""

    def __init__(self, text: np.ndarray, alphabet: int, depth: int):
        self.suffixes = suffix_order(text, depth)
        self._matrix = WaveletMatrix(text[self.suffixes - 1], alphabet)
        self._below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        self.size = len(text)

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol on the left."""
        below = self._below[symbols]
        return below + self._matrix.rank(symbols, low), below + self._matrix.rank(symbols, high)


def repeated_windows(text: np.ndarray, starts: np.ndarray, alphabet: int, width: int) -> tuple[FMIndex, np.ndarray, np.ndarray, np.ndarray]:
    """Which of the windows at ``starts`` occur twice or more, with their intervals."""
    index = FMIndex(text, alphabet, width)
    window = np.arange(len(starts))
    low = np.zeros(len(starts), np.int64)
    high = np.full(len(starts), index.size, np.int64)
    for step in range(width - 1, -1, -1):
        low, high = index.extend(text[starts[window] + step], low, high)
        several = high - low > 1
        window, low, high = window[several], low[several], high[several]
    return index, window, low, high


def resolve_pieces(gram, piece, doc, at, size, words, width: int = WIDTH) -> tuple[np.ndarray, list[list[int]]]:
    """Distinct pieces' first occurrences (indexes), and the windows of each that start earlier elsewhere."""
    keys = anchors.pair_keys(gram.view(np.uint64), piece.view(np.uint64))
    order = np.lexsort((at, doc, keys))
    firsts = order[np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))] if len(order) else order
    firsts = firsts[np.lexsort((at[firsts], doc[firsts]))]
    begin = (np.cumsum(size) - size)[firsts]
    lengths = size[firsts]
    total = int(lengths.sum()) + len(firsts)
    place = np.cumsum(lengths + 1) - lengths - 1  # of each piece in the text
    inner = np.repeat(np.arange(len(firsts)), lengths)
    offset = np.arange(len(inner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values, ids = np.unique(words[begin[inner] + offset], return_inverse=True)
    text = np.zeros(total, np.int64)
    text[place[inner] + offset] = ids + 1
    windows = offset <= lengths[inner] - width
    starts = (place[inner] + offset)[windows]
    index, window, low, high = repeated_windows(text, starts, len(values) + 1, width)
    piece_of = np.zeros(total, np.int64)
    piece_of[place[inner] + offset] = inner
    # Equal windows share an interval; its first piece is looked up once.
    lows, which = np.unique(low, return_index=True)
    ends = np.stack([lows, high[which]], 1).ravel()
    ranked = np.append(piece_of[index.suffixes], 0)
    lowest = np.minimum.reduceat(ranked, ends)[::2] if len(ends) else lows
    own = inner[windows][window]
    later = lowest[np.searchsorted(lows, low)] < own
    flags = np.zeros(total, bool)
    flags[starts[window[later]]] = True
    ranges: list[list[int]] = [[] for _ in firsts]
    for i in np.unique(own[later]).tolist():
        ranges[i] = anchors.to_ranges(flags[place[i] : place[i] + lengths[i] - width + 1])
    return firsts, ranges


def _pack(taken, shards: int) -> Iterator[dict]:
    """The distinct pieces of a task by shard, each at its first occurrence in the task."""
    parts = [
        (
            f.gram[c], f.piece[c], ids, f.first[c] - f.bounds[f.doc[c]],
            f.last[c] + WIDTH - f.first[c], f.first[c], np.full(len(c), i),
        )
        for i, (f, c, ids, _) in enumerate(taken)
    ]
    if not parts or not sum(len(p[0]) for p in parts):
        return
    gram, piece, doc, at, size, start, block = (np.concatenate(p) for p in zip(*parts, strict=True))
    keys = anchors.pair_keys(gram, piece)
    shard = (gram % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((at, doc, keys, shard))
    order = order[np.append(True, keys[order][1:] != keys[order][:-1])]
    out: dict[str, list] = {n: [] for n in ("shard", "gram", "piece", "doc", "at", "size", "words")}
    bounds = np.flatnonzero(np.append(True, shard[order][1:] != shard[order][:-1]))
    for chosen in np.split(order, bounds[1:]):
        out["shard"].append(int(shard[chosen[0]]))
        out["gram"].append(gram[chosen].view(np.int64))
        out["piece"].append(piece[chosen].view(np.int64))
        out["doc"].append(doc[chosen])
        out["at"].append(at[chosen])
        out["size"].append(size[chosen].astype(np.int32))
        words = [taken[b][0].values[s : s + n] for b, s, n in zip(block[chosen], start[chosen], size[chosen], strict=True)]
        out["words"].append(np.concatenate(words).view(np.int64))
    yield out


def _search_shard(rows: pa.Table) -> pa.Table:
    flat = {
        n: rows.column(n).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        for n in ("gram", "piece", "doc", "at", "size", "words")
    }
    flat["size"] = flat["size"].astype(np.int64)
    firsts, ranges = resolve_pieces(**flat)
    return pa.table(
        {
            "gram": pa.array(flat["gram"][firsts]),
            "piece": pa.array(flat["piece"][firsts]),
            "first_doc": pa.array(flat["doc"][firsts]),
            "ranges": pa.array(ranges, pa.list_(pa.int32())),
        }
    )


SCHEME = anchors.Scheme(anchors.word_symbols, WIDTH, GRAM)


def _resolve(rows: DataFrame, multiple: DataFrame, grams: DataFrame) -> DataFrame:
    shards, larger = anchors.shard_count(grams, shuffle_width(rows), SHARD)
    packed = anchors.pieces(rows, SCHEME, multiple.where(F.col("n") <= SHARD), _pack, shards, _PACKED)
    resolved = packed.groupBy("shard").applyInArrow(lambda t: _search_shard(t), _RESOLVED)
    if larger:
        hot = multiple.where(F.col("n") > SHARD)
        later = F.col("seen") < F.col("start")
        resolved = resolved.unionByName(anchors.by_windows(rows, SCHEME, hot, F.min("start"), later))
    return stored(resolved)


def removed_words(ids: np.ndarray, n_words: int, found, hits) -> np.ndarray:
    """Which words of a block go."""
    if found is None or not len(found.gram):
        return np.zeros(n_words, bool)
    entry = hits.places(found)
    known = entry >= 0
    # The first place of a piece in the first document that has it stays.
    key = anchors.pair_keys(found.gram, found.piece) ^ blocks.mix(found.doc.astype(np.uint64))
    first_here = np.zeros(len(key), bool)
    first_here[np.unique(key, return_index=True)[1]] = True
    original = np.zeros(len(key), bool)
    original[known] = hits.first_doc[entry[known]] == ids[found.doc[known]]
    original &= first_here
    whole = known & ~original
    several = np.flatnonzero(known & original)
    of, start, end = hits.window_ranges(entry[several])
    firsts = np.concatenate([found.first[whole], found.first[several][of] + start])
    ends = np.concatenate([found.last[whole] + 1, found.first[several][of] + end])
    return anchors.windows_mask(n_words, firsts, ends, WIDTH)


def kept_bytes(words: blocks.Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words, one space between, as data and offsets per document."""
    data = words.data.copy()
    steps = np.zeros(len(data) + 1, np.int32)
    np.add.at(steps, words.starts[kept], 1)
    np.add.at(steps, words.ends[kept], -1)
    take = np.cumsum(steps[: len(data)]) > 0
    # A space follows each kept word but the last of its document.
    at = np.flatnonzero(kept)
    doc = np.searchsorted(words.bounds, at, "right") - 1
    inner = at[:-1][doc[:-1] == doc[1:]]
    data[words.ends[inner]] = 32
    take[words.ends[inner]] = True
    return data[take], np.concatenate([[0], np.cumsum(take)])[words.offsets]


def _report(ids, data, offsets, found, hits) -> dict:
    words = blocks.Words(data, offsets)
    gone = removed_words(ids, len(words.starts), found, hits)
    out, bounds = kept_bytes(words, ~gone)
    raw = out.tobytes()
    pairs = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    return {
        "doc_id": ids, "n_words": np.diff(words.bounds),
        "n_removed": blocks.per_document(gone, words.bounds),
        "kept_sha256": [hashlib.sha256(raw[a:b]).hexdigest() for a, b in pairs],
    }


def _texts(ids, data, offsets, found, hits) -> dict:
    words = blocks.Words(data, offsets)
    out, bounds = kept_bytes(words, ~removed_words(ids, len(words.starts), found, hits))
    raw = out.tobytes()
    pairs = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    return {"doc_id": ids, "text": [raw[a:b].decode() for a, b in pairs]}


def _with_null(found: DataFrame) -> DataFrame:
    return found.withColumn("doc_id", F.nullif("doc_id", F.lit(anchors.NO_ID)))


def report(docs: DataFrame) -> DataFrame:
    """Per document: words, removed words and the digest of the kept words joined by spaces."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _with_null(anchors.settle(docs, SCHEME, _resolve, _report, schema))


def deduplicate(docs: DataFrame) -> DataFrame:
    """Per document its kept words, joined by spaces."""
    return _with_null(anchors.settle(docs, SCHEME, _resolve, _texts, "doc_id long, text string"))
