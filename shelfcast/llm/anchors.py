"""Content-defined anchors: which repeated windows must be compared, without moving every window.

Take all windows of ``width`` symbols (bytes or words) of a document. Inside a window, the
``gram`` consecutive symbols with the smallest hash, the leftmost of equal ones, are its anchor. It
depends on nothing but the window's content, so equal windows have equal anchors at equal offsets.
Neighbouring windows mostly share one anchor; the windows of one anchor occurrence form a piece,
the symbols from its first window's start to its last window's end.

Hence two windows can only be equal if their anchors' grams are: a gram that occurs once settles
all its windows, and one whose occurrences all have the same piece is settled by counting. Only
grams with several different pieces need their text compared (``exchange``), a small part of a
corpus. All steps key on content, so hot grams collapse in each task before they are shuffled. A
gram with more occurrences than a shard takes is not sent to one: its windows are (``by_windows``),
each under its own hash, so a passage in very many documents spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import blocks
from shelfcast.llm.tables import map_batches, stored

#: Stands for a null id inside; sorts before all others.
NO_ID = -(2**63)


@dataclass(frozen=True)
class Scheme:
    """How texts become symbols, and the widths of windows and grams."""

    symbols: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    width: int
    gram: int
    #: Whether the symbols' values are needed after anchors are found.
    keeps_values: bool = True


def byte_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return blocks.byte_values(data), offsets


def word_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = blocks.Words(data, offsets)
    return words.hashes(), words.bounds


@dataclass
class Found:
    """Anchor occurrences of a block, by position; ``first`` and ``last`` are window starts."""

    doc: np.ndarray
    gram: np.ndarray
    piece: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    values: np.ndarray
    bounds: np.ndarray


def find(scheme: Scheme, data: np.ndarray, offsets: np.ndarray) -> Found:
    values, bounds = scheme.symbols(data, offsets)
    n, width, gram = len(values), scheme.width, scheme.gram
    none = np.zeros(0, np.int64)
    if n < width:
        return Found(none, none.view(np.uint64), none.view(np.uint64), none, none, none, values, bounds)
    sums = blocks.Prefix(values)
    grams = sums.hash(np.s_[: n - gram + 1], np.s_[gram:])
    # Hash above, position below: the minimum is the leftmost of the smallest hashes.
    best = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    reach, span = width - gram + 1, 1
    while 2 * span <= reach:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < reach:
        best = np.minimum(best[: span - reach], best[reach - span :])
    lengths = np.diff(bounds)
    fits = np.maximum(lengths - width + 1, 0)
    starts = np.repeat(bounds[:-1] - np.cumsum(fits) + fits, fits) + np.arange(fits.sum())
    owner = (best[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(owner), bool)
    new[1:] = owner[1:] != owner[:-1]
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(owner)) - 1 if len(begin) else begin
    at, first, last = owner[begin], starts[begin], starts[end]
    piece = sums.hash(first, last + width) ^ blocks.mix((last - first).astype(np.uint64))
    doc = np.searchsorted(bounds, at, "right") - 1
    values = values if scheme.keeps_values else none.view(np.uint64)
    return Found(doc, grams[at], piece, at, first, last, values, bounds)


def pair_keys(gram: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """One key for a gram and a piece."""
    return blocks.mix(gram ^ blocks.mix(piece))


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(
        F.coalesce(docs[key].cast("long"), F.lit(NO_ID)).alias("doc_id"), docs[text].alias("text")
    )


def _told_apart(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows under ids that tell texts apart, and the given ids of these names if they are not the same.

    Where an id has several rows, every distinct (id, text) gets a number in the order of id, null
    first, and text hash. The numbers come from range partitions, so an id with very many texts
    spreads; rows alike in both keep one name.
    """
    rows = docs.select(docs[key].cast("long").alias("given"), docs[text].alias("text"))
    most = rows.groupBy("given").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if most < 2:
        return keyed(docs, text, key), None
    hashed = rows.withColumn("text_md5", F.md5(F.coalesce("text", F.lit(""))))
    pairs = hashed.select("given", "text_md5").distinct().orderBy("given", "text_md5")
    names = stored(pairs.withColumn("doc_id", F.monotonically_increasing_id()))
    own = names.withColumnsRenamed({"given": "own_id", "text_md5": "own_md5"})
    same = hashed["given"].eqNullSafe(own["own_id"]) & (hashed["text_md5"] == own["own_md5"])
    return hashed.join(own, same).select("doc_id", "text"), names.select("doc_id", "given")


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def repeated_grams(rows: DataFrame, scheme: Scheme) -> DataFrame:
    """Grams that occur twice or more: occurrences, whether they have one piece, lowest document."""

    def occurrences(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = _ids(batch.column(0))
        parts = []
        for first, last, data, offsets in blocks.text_blocks(batch.column(1)):
            found = find(scheme, data, offsets)
            parts.append((found.gram, found.piece, ids[first:last][found.doc]))
        if not parts:
            return
        gram, piece, doc = (np.concatenate(p) for p in zip(*parts, strict=True))
        if not len(gram):
            return
        # Equal pieces collapse here, before they are shuffled.
        order = np.argsort(pair_keys(gram, piece), kind="stable")
        keys = pair_keys(gram, piece)[order]
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        yield {
            "gram": _signed(gram[order][begin]),
            "piece": _signed(piece[order][begin]),
            "n": np.diff(np.append(begin, len(keys))),
            "doc": np.minimum.reduceat(doc[order], begin),
        }

    found = map_batches(rows, occurrences, "gram long, piece long, n long, doc long")
    counted = found.groupBy("gram").agg(
        F.sum("n").alias("n"),
        F.min("piece").alias("lowest"),
        F.max("piece").alias("highest"),
        F.min("doc").alias("first_doc"),
    )
    return counted.where("n > 1").select(
        "gram", "n", (F.col("lowest") == F.col("highest")).alias("single"), "first_doc"
    )


def hits(rows: DataFrame, scheme: Scheme, grams: DataFrame) -> DataFrame:
    """Per document and repeated gram its pieces, each once; ``n`` counts the gram's occurrences."""

    def occurrences(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = _ids(batch.column(0))
        for first, last, data, offsets in blocks.text_blocks(batch.column(1)):
            found = find(scheme, data, offsets)
            if not len(found.gram):
                continue
            key = pair_keys(found.gram, found.piece) ^ blocks.mix(found.doc.astype(np.uint64))
            _, at = np.unique(key, return_index=True)
            yield {
                "gram": _signed(found.gram[at]),
                "piece": _signed(found.piece[at]),
                "doc": ids[first:last][found.doc[at]],
            }

    found = map_batches(rows, occurrences, "gram long, piece long, doc long")
    return found.join(grams, "gram").select("doc", "gram", "piece", "n", "single", "first_doc")


_HITS = "array<struct<gram:long,piece:long>>"


def pieces(rows: DataFrame, scheme: Scheme, multiple: DataFrame, pack, shards: int, schema: str) -> DataFrame:
    """Sends each task's distinct pieces of ``multiple`` (doc, gram, piece) to shards of grams.

    ``pack(batch of pieces)`` turns the pieces of one shard into one row of ``schema``.
    """
    wanted = multiple.groupBy(F.col("doc").alias("doc_id")).agg(
        F.collect_set(F.struct("gram", "piece")).alias("wanted")
    )

    def send(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = _ids(batch.column(0))
        lists = batch.column(2)
        sets = lists.flatten()
        asked = pair_keys(
            sets.field("gram").to_numpy(zero_copy_only=False).view(np.uint64),
            sets.field("piece").to_numpy(zero_copy_only=False).view(np.uint64),
        )
        of_row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        wanted_keys = np.sort(asked ^ blocks.mix(of_row.astype(np.uint64)))
        taken: list[tuple] = []
        for first, last, data, offsets in blocks.text_blocks(batch.column(1)):
            found = find(scheme, data, offsets)
            if not len(found.gram):
                continue
            key = pair_keys(found.gram, found.piece) ^ blocks.mix((found.doc + first).astype(np.uint64))
            place = np.minimum(np.searchsorted(wanted_keys, key), max(0, len(wanted_keys) - 1))
            chosen = np.flatnonzero(wanted_keys[place] == key) if len(wanted_keys) else place[:0]
            taken.append((found, chosen, ids[first:last][found.doc[chosen]], data))
        yield from pack(taken, shards)

    return map_batches(rows.join(wanted, "doc_id"), send, schema)


def shard_count(grams: DataFrame, least: int, size: int) -> tuple[int, bool]:
    """Shards of about ``size`` occurrences of grams with several pieces; whether a gram exceeds one."""
    fits = F.col("n") <= size
    several = grams.where(~F.col("single"))
    n, larger = several.agg(F.sum(F.when(fits, F.col("n"))), F.count(F.when(~fits, True))).first()
    return max(least, -(-(n or 0) // size)), larger > 0


def _pack_windows(scheme: Scheme) -> Callable:
    """Packs a block's distinct pieces, each at its first occurrence, with the hashes of its windows."""

    def pack(taken, shards: int) -> Iterator[dict]:
        for found, chosen, ids, data in taken:
            if not len(chosen):
                continue
            values = found.values if scheme.keeps_values else scheme.symbols(data, found.bounds)[0]
            keys = pair_keys(found.gram[chosen], found.piece[chosen])
            at = found.first[chosen] - found.bounds[found.doc[chosen]]
            order = np.lexsort((at, ids, keys))
            begin = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
            one = order[begin]
            first = found.first[chosen[one]]
            size = found.last[chosen[one]] - first + 1
            ends = np.cumsum(size)
            starts = np.repeat(first - ends + size, size) + np.arange(ends[-1])
            windows = blocks.Prefix(values).hash(starts, starts + scheme.width)
            yield {
                "gram": _signed(found.gram[chosen[one]]),
                "piece": _signed(found.piece[chosen[one]]),
                "n": np.diff(np.append(begin, len(keys))),
                "doc": ids[one],
                "at": at[one],
                # Signed numbers in the order of the unsigned keys.
                "tie": _signed(keys[one] ^ np.uint64(1 << 63)),
                "windows": pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), _signed(windows)),
            }

    return pack


_WINDOWS = "gram long, piece long, n long, doc long, at long, tie long, windows array<long>"


def by_windows(rows: DataFrame, scheme: Scheme, multiple: DataFrame, seen: Column, goes: Column) -> DataFrame:
    """Settles the pieces of ``multiple`` with every window under its own key, whatever its gram.

    ``seen`` aggregates the equal windows of distinct pieces, with columns ``n`` (occurrences of the
    piece) and ``start`` (its first occurrence); ``goes`` tells from it which windows are in the ranges.
    """
    packed = pieces(rows, scheme, multiple, _pack_windows(scheme), 0, _WINDOWS)
    distinct = stored(
        packed.groupBy("gram", "piece").agg(
            F.sum("n").alias("n"), F.min(F.struct("doc", "at", "tie")).alias("start"), F.first("windows").alias("windows")
        )
    )
    each = distinct.select("gram", "piece", "n", "start", F.posexplode("windows").alias("place", "window"))
    equal = each.groupBy("gram", "window").agg(seen.alias("seen"))
    gone = each.join(equal, ["gram", "window"]).where(goes).groupBy("gram", "piece")
    places = distinct.select("gram", "piece", F.col("start.doc").alias("first_doc")).join(
        gone.agg(F.collect_list("place").alias("places")), ["gram", "piece"], "left"
    )

    def as_ranges(batch: pa.RecordBatch) -> Iterator[dict]:
        ranges = []
        for listed in batch.column(3):
            flags = np.zeros(scheme.width, bool)
            flags[listed.as_py() or []] = True
            ranges.append(to_ranges(flags))
        yield {"gram": batch.column(0), "piece": batch.column(1), "first_doc": batch.column(2), "ranges": ranges}

    return map_batches(places, as_ranges, "gram long, piece long, first_doc long, ranges array<int>")


def settle(
    docs: DataFrame, scheme: Scheme, resolve: Callable, apply: Callable, schema: str, text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """Runs all steps.

    ``resolve(rows, multiple, grams)`` compares pieces: (gram, piece, first_doc, ranges), where
    ranges are window starts relative to the piece's first, [from, to) one after another.
    ``apply(ids, block, lists)`` makes the result rows of one block.
    """
    rows, names = _told_apart(docs, text, key)
    rows = rows if names is None else stored(rows)
    grams = stored(repeated_grams(rows, scheme))
    found = stored(hits(rows, scheme, grams))
    multiple = found.where(~F.col("single")).select("doc", "gram", "piece", "n")
    resolved = resolve(rows, multiple, grams)
    empty = F.array().cast("array<int>")
    settled = (
        found.where("single")
        .select("doc", "gram", "piece", "first_doc", "single", empty.alias("ranges"))
        .unionByName(
            multiple.join(resolved, ["gram", "piece"]).select(
                "doc", "gram", "piece", "first_doc", F.lit(False).alias("single"), "ranges"
            )
        )
    )
    lists = settled.groupBy(F.col("doc").alias("doc_id")).agg(
        F.collect_list(F.struct("gram", "piece", "first_doc", "single", "ranges")).alias("hits")
    )
    joined = rows.join(lists, "doc_id", "left").select("doc_id", "text", "hits")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = _ids(batch.column(0))
        for first, last, data, offsets in blocks.text_blocks(batch.column(1)):
            own = batch.column(2).slice(first, last - first)
            found = find(scheme, data, offsets) if own.null_count < len(own) else None
            yield apply(ids[first:last], data, offsets, found, _Hits(own))

    made = map_batches(joined, run, schema)
    if names is None:
        return made
    others = [c for c in made.columns if c != "doc_id"]
    return made.join(names, "doc_id").select(F.col("given").alias("doc_id"), *others)


class _Hits:
    """Settled pieces of a block's documents, looked up by document, gram and piece."""

    def __init__(self, lists: pa.Array):
        flat = lists.flatten()
        lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(lists)), lengths)
        take = lambda name: flat.field(name).to_numpy(zero_copy_only=False)
        keys = pair_keys(take("gram").view(np.uint64), take("piece").view(np.uint64)) ^ blocks.mix(doc.astype(np.uint64))
        self._order = np.argsort(keys, kind="stable")
        self._keys = keys[self._order]
        self.first_doc, self.single = take("first_doc"), take("single").astype(bool)
        self.ranges = flat.field("ranges")

    def places(self, found: Found) -> np.ndarray:
        """For each anchor occurrence the entry that settles it, or -1."""
        if not len(self._keys) or not len(found.gram):
            return np.full(len(found.gram), -1)
        key = pair_keys(found.gram, found.piece) ^ blocks.mix(found.doc.astype(np.uint64))
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._order[at], -1)

    def window_ranges(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index into ``entries``, relative from and to, of every range of the given entries."""
        taken = self.ranges.take(pa.array(entries))
        lengths = taken.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) // 2
        values = taken.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return np.repeat(np.arange(len(entries)), lengths), values[0::2], values[1::2]


def windows_mask(n: int, firsts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Positions inside windows that start in any [first, end)."""
    steps = np.zeros(n + 1, np.int32)
    some = ends > firsts
    np.add.at(steps, firsts[some], 1)
    np.add.at(steps, np.minimum(ends[some] - 1 + width, n), -1)
    return np.cumsum(steps[:n]) > 0


def to_ranges(flags: np.ndarray) -> list[int]:
    """Runs of set flags as [from, to) one after another."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges.tolist()
