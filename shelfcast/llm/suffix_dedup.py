"""Removes long repeated strings by sorted suffixes, exchanged front-coded and merged by loser trees.

Every byte covered by a ``width``-byte string that also starts anywhere else goes; strings are
judged on the input, never cross documents, and overlaps count. Texts are UTF-8 bytes.

Only suffixes at content-defined anchors are sorted (see ``anchors``), and of those only the ones
whose gram has several different surroundings. Each task sorts its distinct suffixes per shard and
sends them front-coded: the length shared with the suffix before, and the rest. A shard merges the
runs with a loser tree that keeps for every run the prefix it shares with the last output, so a
known prefix is never compared again; the merge yields the common prefixes of neighbours for free.
Sorting the reversed text before the anchors likewise, a window that starts d bytes before an
anchor repeats exactly if another suffix agrees on d bytes to the left and width - d to the right,
which is a matter of ranks. A gram with more occurrences than a shard is settled by counting equal
windows instead.

Defined results: a null or empty text keeps no bytes and loses none; repeated rows are occurrences
of their own, so copies of a text of at least ``width`` bytes lose everything; rows
that share an id, also null, are documents of their own; further columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import anchors
from shelfcast.llm.tables import arrow_schema, shuffle_width, stored

WIDTH, GRAM = 200, 64
#: Occurrences per shard of suffixes, about, and the most of one gram.
SHARD = 40_000

_RUN = (
    "shard int, gram array<long>, piece array<long>, twice array<boolean>, "
    "shared array<int>, rest array<binary>, left array<binary>"
)
_RESOLVED = "gram long, piece long, first_doc long, ranges array<int>"


def common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix, of which ``start`` bytes are known."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    step = 32
    while a[start : start + step] == b[start : start + step]:
        start += step
        step *= 2
    # The first difference lies within the next step bytes.
    low, high = start, min(n, start + step)
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class LoserTree:
    """Merges sorted front-coded runs of (shared, rest); yields (run, text, prefix shared with the last)."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes]]]):
        self._runs = runs
        self._text: list[bytes | None] = []
        for run in runs:
            head = next(run, None)
            self._text.append(None if head is None else head[1])
        self._shared = [0] * len(runs)
        self._size = 1
        while self._size < len(runs):
            self._size *= 2
        self._losers = [-1] * self._size

    def _beats(self, a: int, b: int) -> bool:
        """Whether run a's text comes before run b's; the loser learns its prefix with the winner."""
        if a < 0 or self._text[a] is None:
            return False
        if b < 0 or self._text[b] is None:
            return True
        shared = self._shared
        if shared[a] != shared[b]:
            # The longer prefix shared with the last output decides without a comparison.
            return shared[a] > shared[b]
        x, y = self._text[a], self._text[b]
        n = common(x, y, shared[a])
        wins = n == len(x) if n in (len(x), len(y)) else x[n] < y[n]
        if n == len(x) == len(y):
            wins = a < b
        shared[b if wins else a] = n
        return wins

    def _build(self, node: int) -> int:
        if node >= self._size:
            leaf = node - self._size
            return leaf if leaf < len(self._runs) else -1
        a, b = self._build(2 * node), self._build(2 * node + 1)
        winner, loser = (a, b) if self._beats(a, b) else (b, a)
        self._losers[node] = loser
        return winner

    def __iter__(self) -> Iterator[tuple[int, bytes, int]]:
        if not self._runs:
            return
        winner = self._build(1)
        while winner >= 0 and self._text[winner] is not None:
            text = self._text[winner]
            yield winner, text, self._shared[winner]
            following = next(self._runs[winner], None)
            if following is None:
                self._text[winner] = None
            else:
                self._shared[winner], self._text[winner] = following[0], text[: following[0]] + following[1]
            node = (winner + self._size) // 2
            while node:
                other = self._losers[node]
                if self._beats(other, winner):
                    self._losers[node], winner = winner, other
                node //= 2


def _pack(taken, shards: int) -> Iterator[dict]:
    """One sorted, front-coded run per shard from the pieces of a task."""
    parts = []
    for found, chosen, _, data in taken:
        key = anchors.pair_keys(found.gram[chosen], found.piece[chosen])
        _, at, counts = np.unique(key, return_index=True, return_counts=True)
        raw = data.tobytes()
        for i, n in zip(chosen[at].tolist(), counts.tolist(), strict=True):
            parts.append((
                int(found.gram[i]), int(found.piece[i]), n,
                raw[found.at[i] : found.last[i] + WIDTH], raw[found.first[i] : found.at[i]][::-1],
            ))
    merged: dict[tuple[int, int], list] = {}
    for gram, piece, n, right, left in parts:
        known = merged.setdefault((gram, piece), [0, right, left])
        known[0] += n
    by_shard: dict[int, list] = {}
    for (gram, piece), (n, right, left) in merged.items():
        by_shard.setdefault(gram % shards, []).append((right, left, gram, piece, n > 1))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    out: dict[str, list] = {f.name: [] for f in arrow_fields()}
    for shard, items in by_shard.items():
        items.sort(key=lambda item: item[0])
        shared, rest, before = [], [], b""
        for right, *_ in items:
            n = common(before, right, 0)
            shared.append(n)
            rest.append(right[n:])
            before = right
        out["shard"].append(shard)
        out["gram"].append([signed(i[2]) for i in items])
        out["piece"].append([signed(i[3]) for i in items])
        out["twice"].append([i[4] for i in items])
        out["shared"].append(shared)
        out["rest"].append(rest)
        out["left"].append([i[1] for i in items])
    yield out


def arrow_fields() -> list[pa.Field]:
    kinds = {"gram": pa.int64(), "piece": pa.int64(), "twice": pa.bool_(), "shared": pa.int32()}
    return [pa.field("shard", pa.int32())] + [
        pa.field(n, pa.list_(kinds.get(n, pa.binary()))) for n in ("gram", "piece", "twice", "shared", "rest", "left")
    ]


def repeated_windows(rights: np.ndarray, lefts: np.ndarray, right_size: np.ndarray, left_size: np.ndarray, twice: np.ndarray, width: int, reach: int) -> np.ndarray:
    """For each suffix and distance d whether its window that starts d bytes earlier repeats.

    ``rights`` and ``lefts`` hold, per suffix in its sorted order, the prefix shared with the one
    before; ``lefts`` is a pair (order, shared).
    """
    order, shared = lefts
    n = len(rights)
    out = np.zeros((n, reach), bool)
    left_class = np.empty(n, np.int64)
    for d in range(reach):
        valid = np.flatnonzero((left_size >= d) & (right_size >= width - d))
        if not len(valid):
            continue
        right_class = np.cumsum(rights < width - d)
        left_class[order] = np.cumsum(shared < d)
        keys = (right_class * (n + 1) + left_class)[valid]
        ranked = np.argsort(keys, kind="stable")
        same = keys[ranked][1:] == keys[ranked][:-1]
        out[valid[ranked[1:][same]], d] = True
        out[valid[ranked[:-1][same]], d] = True
        out[valid[twice[valid]], d] = True
    return out


def merge_shard(runs: pa.Table, width: int = WIDTH, gram: int = GRAM) -> pa.Table:
    """Merges the runs of a shard and finds the repeated windows of each piece."""
    columns = {name: runs.column(name).to_pylist() for name in ("gram", "piece", "twice", "shared", "rest", "left")}

    def coded(i: int) -> Iterator[tuple[int, bytes]]:
        return zip(columns["shared"][i], columns["rest"][i], strict=True)

    seen = [0] * runs.num_rows
    grams, pieces, twice, lefts, rights, shared = [], [], [], [], [], []
    for run, text, prefix in LoserTree([coded(i) for i in range(runs.num_rows)]):
        i = seen[run]
        seen[run] += 1
        grams.append(columns["gram"][run][i])
        pieces.append(columns["piece"][run][i])
        twice.append(columns["twice"][run][i])
        lefts.append(columns["left"][run][i])
        rights.append(len(text))
        shared.append(prefix)
    order = sorted(range(len(lefts)), key=lefts.__getitem__)
    left_shared = [0] + [common(lefts[a], lefts[b], 0) for a, b in zip(order, order[1:], strict=False)]
    left_size = np.array([len(x) for x in lefts], np.int64)
    flags = repeated_windows(
        np.array(shared, np.int64), (np.array(order, np.int64), np.array(left_shared, np.int64)),
        np.array(rights, np.int64), left_size, np.array(twice, bool), width, width - gram + 1,
    )
    out: dict[tuple[int, int], list[int]] = {}
    for i in np.flatnonzero(flags.any(1)).tolist():
        # Distance d is the window that starts left_size - d after the piece's first.
        starts = flags[i, : left_size[i] + 1][::-1]
        out[grams[i], pieces[i]] = anchors.to_ranges(starts)
    return pa.table(
        {
            "gram": pa.array([g for g, _ in out], pa.int64()),
            "piece": pa.array([p for _, p in out], pa.int64()),
            "first_doc": pa.array([0] * len(out), pa.int64()),
            "ranges": pa.array(list(out.values()), pa.list_(pa.int32())),
        }
    )


def _resolve(rows: DataFrame, multiple: DataFrame, grams: DataFrame) -> DataFrame:
    shards, larger = anchors.shard_count(grams, shuffle_width(rows), SHARD)
    runs = anchors.pieces(rows, SCHEME, multiple.where(F.col("n") <= SHARD), _pack, shards, _RUN)
    resolved = runs.groupBy("shard").applyInArrow(lambda t: merge_shard(t), _RESOLVED)
    if larger:
        hot = multiple.where(F.col("n") > SHARD)
        resolved = resolved.unionByName(anchors.by_windows(rows, SCHEME, hot, F.sum("n"), F.col("seen") > 1))
    return stored(resolved)


SCHEME = anchors.Scheme(anchors.byte_symbols, WIDTH, GRAM, keeps_values=False)


def removed_bytes(data: np.ndarray, found, hits) -> np.ndarray:
    """Which bytes of a block go."""
    if found is None:
        return np.zeros(len(data), bool)
    entry = hits.places(found)
    single = np.zeros(len(entry), bool)
    single[entry >= 0] = hits.single[entry[entry >= 0]]
    several = np.flatnonzero((entry >= 0) & ~single)
    of, start, end = hits.window_ranges(entry[several])
    firsts = np.concatenate([found.first[single], found.first[several][of] + start])
    ends = np.concatenate([found.last[single] + 1, found.first[several][of] + end])
    return anchors.windows_mask(len(data), firsts, ends, WIDTH)


def _report(ids, data, offsets, found, hits) -> dict:
    gone = removed_bytes(data, found, hits)
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edges] = gone[edges]
    sums = np.concatenate([[0], np.cumsum(gone)])
    spans = np.concatenate([[0], np.cumsum(begins)])
    n_removed = sums[offsets[1:]] - sums[offsets[:-1]]
    digests = []
    for a, b, n in zip(offsets[:-1].tolist(), offsets[1:].tolist(), n_removed.tolist(), strict=True):
        kept = data[a:b][~gone[a:b]] if n else data[a:b]
        digests.append(hashlib.sha256(kept.tobytes()).hexdigest())
    return {
        "doc_id": ids, "n_bytes": np.diff(offsets), "n_removed": n_removed,
        "n_spans": spans[offsets[1:]] - spans[offsets[:-1]], "kept_sha256": digests,
    }


def _texts(ids, data, offsets, found, hits) -> dict:
    gone = removed_bytes(data, found, hits)
    texts = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        texts.append(data[a:b][~gone[a:b]].tobytes().decode("utf-8", "ignore"))
    return {"doc_id": ids, "text": texts}


def _with_null(found: DataFrame) -> DataFrame:
    return found.withColumn("doc_id", F.nullif("doc_id", F.lit(anchors.NO_ID)))


def report(docs: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs and the digest of what is kept."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _with_null(anchors.settle(docs, SCHEME, _resolve, _report, schema))


def deduplicate(docs: DataFrame) -> DataFrame:
    """Per document its text without repeated strings; a character cut in two goes whole."""
    return _with_null(anchors.settle(docs, SCHEME, _resolve, _texts, "doc_id long, text string"))
