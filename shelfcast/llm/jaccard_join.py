"""N-gram Jaccard join by a grouped prefix join, and the classes it links.

A document's set holds the distinct hashes of its five-word shingles (A-Z folded). Two documents
link if 100 * intersection >= 75 * union. Under one order of all shingles, two linked sets share a
shingle among the first ``n // 4 + 1`` of each: its prefix. The order puts frequent shingles last,
as far as the ``FREQUENT`` most frequent ones are known; any order gives the same links.

1. Documents with one set are one class; classes with one prefix and size are one group. Groups
   are named by hashes of their content, so tasks collapse copies before anything is shuffled.
2. Prefixes are dealt by shingle, with the places they hold. Where groups meet, sizes are
   filtered, a list of groups being cut wherever neighbours in size are too far apart, and so are
   places: the first shingle that two sets share must leave enough of both. Equal lists collapse.
3. Lists expand to their classes. Neighbours by size are verified first, and linked classes become
   components; then, within each list, what lies in different components is verified too. So a
   large group of near copies costs its length, not its square, and no link between components is
   lost.
4. Verification first bounds the symmetric difference from below by parity bitmaps, which is exact
   and rejects most pairs, then intersects whole sets.

Defined results: a null or empty text, or one without words, has an empty set and links with
nothing; fewer than five words make one shingle of all; repeated rows fall into one class; a null
id takes part, and a component without any id has a null id; further columns are left out; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm import blocks
from shelfcast.llm.components import components
from shelfcast.llm.tables import map_batches, release, shuffle_width, stored

#: Link from this share of the union, in percent.
PERCENT = 75
#: Most shingles whose frequency orders the prefixes (12 bytes each in every task).
FREQUENT = 1 << 17
#: Occurrences from which a shingle counts as frequent.
IN_ALL = 16
#: Prefix entries per shard, about.
SHARD = 1_000_000
#: Members from which a list counts as long, and the random orders its neighbours are taken from.
SHORT, CHAINS = 8, 3
#: Members of a tile of a long list, and of a part of short lists, about.
TILE, TILED = 1024, 50_000
#: Bits of the filter that spares texts a shuffle when no pair needs them.
FILTER_BITS = 1 << 22


def prefix_length(n: int) -> int:
    return n - -(-n * PERCENT // 100) + 1


def signature(values: np.ndarray) -> int:
    """Name of a set, from its size and two sums over its members."""
    one = int(blocks.mix(values).sum(dtype=np.uint64))
    two = int(blocks.mix(values ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64))
    total = (one + two * 0x9E3779B97F4A7C15 + len(values)) % (1 << 64)
    return int(blocks.mix(np.array([total], np.uint64))[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def parity_bitmap(values: np.ndarray) -> bytes:
    """Parity of how many members hash to each bit; twice as many bits as members at least."""
    bits = max(64, 1 << int(2 * len(values) - 1).bit_length()) if len(values) else 64
    counts = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(counts.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their bitmaps."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def linked(common: int, a: int, b: int) -> bool:
    return 100 * common >= PERCENT * (a + b - common)


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for first, _, data, offsets in blocks.text_blocks(column):
        for i, values in enumerate(blocks.shingle_sets(blocks.Words(data, offsets))):
            yield first + i, values


# --------------------------------------------------------------------- classes and frequencies

_SURVEY = "doc_id long, text_hash long, n long, sig long, bitmap binary"


def _survey(rows: DataFrame) -> DataFrame:
    """A row per document: its set's size, name and bitmap (once per class and task)."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        found, seen = [], set()
        for _, values in _sets(batch.column(1)):
            sig = signature(values) if len(values) else 0
            found.append((len(values), _signed(sig), None if sig in seen else parity_bitmap(values)))
            seen.add(sig)
        yield {
            "doc_id": batch.column(0), "text_hash": batch.column(2), "n": [f[0] for f in found],
            "sig": [f[1] for f in found], "bitmap": [f[2] for f in found],
        }

    return map_batches(rows, run, _SURVEY)


def _short(values: np.ndarray, shards: int) -> np.ndarray:
    """What frequencies are kept by: the shard of a shingle and 32 bits of its hash."""
    return (values & np.uint64(0xFFFFFFFF00000000)) | (values % np.uint64(shards))


def _frequent(rows: DataFrame, shards: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The most frequent shingles and how often they occur, counted over all documents.

    At most FREQUENT: the bound only limits how well prefixes avoid frequent shingles. The same
    hashes of a task travel packed, four bytes each.
    """

    def send(batch: pa.RecordBatch) -> Iterator[dict]:
        seen, sets = set(), []
        for _, values in _sets(batch.column(1)):
            sig = signature(values) if len(values) else 0
            if sig not in seen:
                seen.add(sig)
                sets.append(values)
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        sets.clear()
        shard = (every % np.uint64(shards)).astype(np.int32)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(shards + 1))
        every = (every >> np.uint64(32)).astype(np.uint32)[order]
        parts = [(s, every[bounds[s] : bounds[s + 1]].tobytes()) for s in range(shards) if bounds[s] < bounds[s + 1]]
        yield {"shard": [p[0] for p in parts], "hashes": [p[1] for p in parts]}

    def count(table: pa.Table) -> pa.Table:
        every = np.concatenate([np.frombuffer(b.as_buffer(), np.uint32) for b in table.column("hashes")])
        every.sort()
        often = every[IN_ALL - 1 :][every[IN_ALL - 1 :] == every[: max(0, len(every) - IN_ALL + 1)]]
        values = blocks.distinct(often)
        times = np.searchsorted(every, values, "right") - np.searchsorted(every, values)
        del every, often
        release()
        key = (values.astype(np.uint64) << np.uint64(32)) | np.uint64(table.column("shard")[0].as_py())
        return pa.table({"shingle": pa.array(key.view(np.int64)), "times": pa.array(times, pa.int64())})

    sent = map_batches(rows, send, "shard int, hashes binary")
    counted = sent.groupBy("shard").applyInArrow(count, "shingle long, times long")
    top = counted.orderBy(F.desc("times"), "shingle").limit(FREQUENT).toArrow()
    return top.column(0).to_numpy().view(np.uint64), top.column(1).to_numpy(), shards


class Order:
    """The order of shingles: those not known as frequent by hash, then the others by frequency."""

    def __init__(self, values: np.ndarray, times: np.ndarray, shards: int):
        order = np.argsort(values)
        self._values, self._times, self._shards = values[order], times[order], shards
        self._hint = np.zeros(1 << 22, bool)
        self._hint[values >> np.uint64(42)] = True

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """The first shingles of a sorted set."""
        length = prefix_length(len(values))
        maybe = np.flatnonzero(self._hint[values >> np.uint64(42)])
        if not len(maybe):
            return values[:length]
        short = _short(values[maybe], self._shards)
        at = np.minimum(np.searchsorted(self._values, short), len(self._values) - 1)
        known = self._values[at] == short
        times = np.zeros(len(values), np.int64)
        times[maybe[known]] = self._times[at[known]]
        return values[np.argsort(times, kind="stable")[:length]]


# ------------------------------------------------------------------------------ grouped prefixes

#: Places in a prefix are kept as parts of the set's size, rounded down to this fraction of it.
STEPS = 252

_DEALT = "shard int, hashes binary, places binary, counts binary, groups binary, sizes binary, sigs binary, sig_groups binary"
_LISTS = "kind int, name long, members array<long>, places array<int>"


def _deal(rows: DataFrame, frequent: tuple[np.ndarray, np.ndarray, int], shards: int) -> DataFrame:
    """Prefix entries by shard of their shingle, and classes by shard of their group."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        order_, seen_sigs, seen = Order(*shared.value), set(), set()
        prefixes, groups, sizes, sigs, sig_groups = [], [], [], [], []
        for _, values in _sets(batch.column(1)):
            sig = signature(values) if len(values) else 0
            if not len(values) or sig in seen_sigs:
                continue
            seen_sigs.add(sig)
            prefix = order_.prefix(values)
            group = signature(np.append(prefix, np.uint64(len(values))))
            sigs.append(sig)
            sig_groups.append(group)
            if group not in seen:
                seen.add(group)
                prefixes.append(prefix)
                groups.append(group)
                sizes.append(len(values))
        if not sigs:
            return
        hashes = np.concatenate(prefixes)
        owner = np.repeat(np.arange(len(groups)), [len(p) for p in prefixes])
        places = np.concatenate([np.arange(len(p)) * STEPS // n for p, n in zip(prefixes, sizes, strict=True)]).astype(np.uint8)
        groups, sizes = np.array(groups, np.uint64), np.array(sizes, np.uint32)
        sigs, sig_groups = np.array(sigs, np.uint64), np.array(sig_groups, np.uint64)
        shard = (blocks.mix(hashes) % np.uint64(shards)).astype(np.int64)
        ranked = np.argsort(shard * len(groups) + owner, kind="stable")
        bounds = np.searchsorted(shard[ranked], np.arange(shards + 1))
        sig_shard = (sig_groups % np.uint64(shards)).astype(np.int64)
        sig_ranked = np.argsort(sig_shard, kind="stable")
        sig_bounds = np.searchsorted(sig_shard[sig_ranked], np.arange(shards + 1))
        out: dict[str, list] = {n: [] for n in ("shard", "hashes", "places", "counts", "groups", "sizes", "sigs", "sig_groups")}
        for s in range(shards):
            own = ranked[bounds[s] : bounds[s + 1]]
            mine = sig_ranked[sig_bounds[s] : sig_bounds[s + 1]]
            if not len(own) and not len(mine):
                continue
            who, counts = np.unique(owner[own], return_counts=True)
            out["shard"].append(s)
            out["hashes"].append(hashes[own].tobytes())
            out["places"].append(places[own].tobytes())
            out["counts"].append(counts.astype(np.uint32).tobytes())
            out["groups"].append(groups[who].tobytes())
            out["sizes"].append(sizes[who].tobytes())
            out["sigs"].append(sigs[mine].tobytes())
            out["sig_groups"].append(sig_groups[mine].tobytes())
        yield out

    return map_batches(rows, run, _DEALT)


def _tail(size, place):
    """What a set has left from a place on, at most: sizes and places as arrays or columns."""
    if isinstance(size, Column):
        return size - F.floor(place * size / STEPS)
    return size - place.astype(np.int64) * size // STEPS


def _may_link(n: Column, m: Column, tail: Column, other: Column) -> Column:
    near = 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)
    return near & ((100 + PERCENT) * F.least(tail, other) >= PERCENT * (n + m))


def _lists(table: pa.Table) -> pa.Table:
    """Of one shard: lists of groups that share a prefix shingle and are near in size, and each
    group's classes."""

    def joined(name: str, kind) -> np.ndarray:
        return np.concatenate([np.frombuffer(b, kind) for b in table.column(name).to_pylist()])

    hashes = joined("hashes", np.uint64)
    counts = joined("counts", np.uint32)
    group, size = np.repeat(joined("groups", np.uint64), counts), np.repeat(joined("sizes", np.uint32), counts).astype(np.int64)
    place = joined("places", np.uint8)
    order = np.lexsort((group, size, hashes))
    hashes, group, size, place = hashes[order], group[order], size[order], place[order]
    if len(hashes):
        fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (group[1:] != group[:-1]))
        hashes, group, size, place = hashes[fresh], group[fresh], size[fresh], place[fresh]
    near = np.zeros(len(hashes), bool)
    near[1:] = (hashes[1:] == hashes[:-1]) & (100 * size[:-1] >= PERCENT * size[1:])
    begin = np.flatnonzero(~near)
    lengths = np.diff(np.append(begin, len(hashes)))
    # The smaller of two linked sets has its first shared shingle early.
    early = np.add.reduceat(_tail(size, place) * (100 + PERCENT) >= 2 * PERCENT * size, begin) if len(begin) else begin
    some = (lengths > 1) & (early > 0)
    begin, lengths = begin[some], lengths[some]
    inside = np.repeat(begin, lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    edges = np.cumsum(lengths) - lengths
    names = np.add.reduceat(blocks.mix(group[inside] + place[inside]), edges) if len(edges) else np.zeros(0, np.uint64)
    names, at = np.unique(blocks.mix(names + lengths.astype(np.uint64)), return_index=True)
    members = [group[begin[i] : begin[i] + lengths[i]].view(np.int64) for i in at.tolist()]
    places = [place[begin[i] : begin[i] + lengths[i]].astype(np.int32) for i in at.tolist()]
    del hashes, group, size, place, order, near, inside
    release()
    sigs, of = joined("sigs", np.uint64), joined("sig_groups", np.uint64)
    order = np.lexsort((sigs, of))
    sigs, of = sigs[order], of[order]
    fresh = np.append(True, (sigs[1:] != sigs[:-1]) | (of[1:] != of[:-1])) if len(sigs) else np.zeros(0, bool)
    sigs, of = sigs[fresh], of[fresh]
    first = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
    classes = np.split(sigs.view(np.int64), first[1:]) if len(first) else []
    return pa.table(
        {
            "kind": pa.array([0] * len(names) + [1] * len(classes), pa.int32()),
            "name": pa.array(np.concatenate([names.view(np.int64), of[first].view(np.int64)])),
            "members": pa.array([*members, *classes], pa.list_(pa.int64())),
            "places": pa.array([*places, *([None] * len(classes))], pa.list_(pa.int32())),
        }
    )


# ------------------------------------------------------------------------------------ verification


def _pruned(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose bitmaps allow a link, with the documents that hold the sets."""
    side = lambda x: classes.select(*[F.col(c).alias(f"{c}_{x}") for c in ("sig", "n", "holder", "bitmap")])
    both = pairs.join(side("a"), F.col("a") == F.col("sig_a")).join(side("b"), F.col("b") == F.col("sig_b"))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        sizes = zip(get["n_a"].to_pylist(), get["n_b"].to_pylist(), strict=True)
        maps = zip(get["bitmap_a"].to_pylist(), get["bitmap_b"].to_pylist(), strict=True)
        # A link needs common >= PERCENT * (a + b) / (100 + PERCENT).
        keep = [
            (100 + PERCENT) * (a + b - least_difference(x, y)) >= 2 * PERCENT * (a + b)
            for (a, b), (x, y) in zip(sizes, maps, strict=True)
        ]
        yield {n: get[n].filter(pa.array(keep, pa.bool_())) for n in ("a", "b", "n_a", "n_b", "holder_a", "holder_b")}

    chosen = both.select("a", "b", "n_a", "n_b", "holder_a", "holder_b", "bitmap_a", "bitmap_b")
    return map_batches(chosen, run, "a long, b long, n_a long, n_b long, holder_a long, holder_b long")


def _folded(maps: list[np.ndarray], words: int) -> np.ndarray:
    """Bitmaps as rows of so many words; longer ones are folded, which keeps parities."""
    out = []
    for x in maps:
        while len(x) > words:
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        out.append(x)
    return np.stack(out)


def _list_pairs(sig, n, tail, root, tile, maps) -> list[tuple[int, int]]:
    """Pairs of one list that lie in different components and may link.

    ``tile`` tells the two halves of a part of a long list apart; -1 is a whole list.
    """
    order = np.argsort(n, kind="stable")
    sig, n, tail, root, tile = (x[order] for x in (sig, n, tail, root, tile))
    maps = [maps[i] for i in order.tolist()]
    size = np.array([len(x) for x in maps])
    by_width = {int(w): _folded(maps, int(w)) if w == size.min() else None for w in np.unique(size)}
    out = []
    for i in range(len(sig) - 1):
        # Sizes ascend, so bitmaps of later members are as long or longer.
        last = int(np.searchsorted(n, n[i] * 100 // PERCENT, "right"))
        j = np.arange(i + 1, last)
        both = n[i] + n[j]
        j = j[
            (root[j] != root[i])
            & ((tile[j] != tile[i]) | (tile[i] < 0))
            & ((100 + PERCENT) * np.minimum(tail[i], tail[j]) >= PERCENT * both)
        ]
        if not len(j):
            continue
        width = int(size[i])
        if by_width[width] is None:
            short = next(k for k in range(len(maps)) if size[k] >= width)
            by_width[width] = np.vstack([np.zeros((short, width), np.uint64), _folded(maps[short:], width)])
        table = by_width[width]
        apart = np.bitwise_count(table[j] ^ table[i]).sum(1, dtype=np.int64)
        both = n[i] + n[j]
        j = j[(100 + PERCENT) * (both - apart) >= 2 * PERCENT * both]
        out += [(min(int(sig[i]), int(sig[x])), max(int(sig[i]), int(sig[x]))) for x in j.tolist()]
    return out


def _across(apart: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) within lists, from different components, whose bitmaps allow a link.

    Lists are compared in tasks, whole or, when long, in squares of two tiles, each member being
    sent once per tile; only pairs that pass the bitmaps come out.
    """
    n_rows = apart.count()
    parts = max(shuffle_width(apart), -(-n_rows // TILED))
    tiles = F.ceil(F.col("k") / TILE).cast("int")
    own = F.when(F.col("k") > TILE, F.pmod(F.xxhash64("sig"), tiles).cast("int")).otherwise(-1)
    placed = apart.join(classes.select("sig", "bitmap"), "sig").withColumns({"tiles": tiles, "own": own})
    whole = placed.where("own < 0").select(
        F.pmod("list", F.lit(parts)).alias("part"), F.lit(-1).alias("low"), F.lit(-1).alias("high"), F.lit(-1).alias("tile"),
        "list", "sig", "n", "tail", "root", "bitmap",
    )
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    long = placed.where("own >= 0").withColumn("other", other)
    # In the square of a tile with itself every member is its own tile.
    squares = long.select(
        F.col("list").alias("part"), F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("tile"),
        "list", "sig", "n", "tail", "root", "bitmap",
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("list")
        get = {c: table.column(c).to_numpy() for c in ("list", "sig", "n", "tail", "root", "tile")}
        maps = [np.frombuffer(b.as_buffer(), np.uint64) for b in table.column("bitmap")]
        edges = np.flatnonzero(np.append(True, get["list"][1:] != get["list"][:-1])).tolist() + [len(maps)]
        found: set[tuple[int, int]] = set()
        for a, b in zip(edges, edges[1:], strict=False):
            found.update(_list_pairs(*(get[c][a:b] for c in ("sig", "n", "tail", "root", "tile")), maps[a:b]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    met = whole.unionByName(squares).groupBy("part", "low", "high")
    return met.applyInArrow(compare, "a long, b long").distinct()


def _id_filter(ids: DataFrame) -> np.ndarray:
    """Bits set for the hashes of holders: a fixed number of them, however many there are."""
    bit = F.pmod(F.xxhash64("holder"), F.lit(FILTER_BITS))
    words = (
        ids.select((bit / 32).cast("int").alias("word"), F.expr("shiftleft(1L, int(pmod(xxhash64(holder), 32)))").alias("bits"))
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    out[words.column(0).to_numpy()] = words.column(1).to_numpy().astype(np.uint32)
    return out


def _holder() -> Column:
    """Names a row by id and text; rows that share a name are told apart by their sets."""
    return F.xxhash64("doc_id", "text_hash")


def _verified(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) that link, by their whole sets."""
    asked = (
        pairs.select(F.col("holder_a").alias("holder"), F.col("a").alias("sig"), "a", "b")
        .unionByName(pairs.select(F.col("holder_b").alias("holder"), F.col("b").alias("sig"), "a", "b"))
        .groupBy("holder")
        .agg(F.collect_list(F.struct("sig", "a", "b")).alias("asked"))
    )
    wanted = rows.sparkSession.sparkContext.broadcast(_id_filter(asked.select("holder")))

    def squeeze(batch: pa.RecordBatch) -> Iterator[dict]:
        bits = wanted.value
        place = batch.column(2).to_numpy(zero_copy_only=False)
        chosen = np.flatnonzero((bits[place // 32] >> (place % 32).astype(np.uint32)) & np.uint32(1))
        if len(chosen):
            press = zstandard.ZstdCompressor(level=1).compress
            # Copies of a row would all answer for it: one of a batch is enough.
            bodies = {(batch.column(0)[i].as_py(), batch.column(1)[i].as_py() or "") for i in chosen.tolist()}
            yield {"holder": [h for h, _ in bodies], "body": [press(t.encode()) for _, t in bodies]}

    place = F.pmod(F.xxhash64("holder"), F.lit(FILTER_BITS)).cast("int")
    named = rows.withColumn("text_hash", text_hash(F.col("text"))).withColumn("holder", _holder())
    texts = map_batches(named.select("holder", "text", place.alias("place")), squeeze, "holder long, body binary")

    def send(batch: pa.RecordBatch) -> Iterator[dict]:
        unpack = zstandard.ZstdDecompressor().decompress
        asked_ = batch.column(2)
        for i in range(batch.num_rows):
            text = unpack(batch.column(1)[i].as_py()).decode()
            [(_, values)] = _sets(pa.array([text], pa.large_string()))
            sig = _signed(signature(values)) if len(values) else 0
            own = [x for x in asked_[i].as_py() if x["sig"] == sig]
            if own:
                raw = values.tobytes()
                yield {"a": [x["a"] for x in own], "b": [x["b"] for x in own], "members": [raw] * len(own)}

    sent = map_batches(texts.join(asked, "holder"), send, "a long, b long, members binary")
    met = sent.groupBy("a", "b").agg(F.min("members").alias("x"), F.max("members").alias("y"))

    def check(batch: pa.RecordBatch) -> Iterator[dict]:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(linked(common, len(x), len(y)))
        chosen = pa.array(keep, pa.bool_())
        yield {"a": batch.column(0).filter(chosen), "b": batch.column(1).filter(chosen)}

    return map_batches(met, check, "a long, b long")


def join(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: id, size of its set, name of its class (null for an empty set), its component's
    name and the component's smallest id."""
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    members = stored(_survey(rows.withColumn("text_hash", text_hash(F.col("text")))))
    # Any one row holds a class's text, with or without an id.
    classes = stored(
        members.where("n > 0")
        .groupBy("sig")
        .agg(F.first("n").alias("n"), F.min(_holder()).alias("holder"), F.max("bitmap").alias("bitmap"))
    )
    total = members.agg(F.sum("n")).first()[0] or 0
    shards = max(shuffle_width(rows), -(-total // (4 * SHARD)))
    dealt = _deal(rows, _frequent(rows, shards), shards)
    lists = stored(dealt.groupBy("shard").applyInArrow(lambda t: _lists(t), _LISTS))
    groups = lists.where("kind = 1").select(F.col("name").alias("group"), F.col("members").alias("sigs"))
    by_shingle = (
        lists.where("kind = 0")
        .dropDuplicates(["name"])
        .select(F.col("name").alias("list"), F.explode(F.arrays_zip("members", "places")).alias("m"))
        .select("list", F.col("m.members").alias("group"), F.col("m.places").alias("place"))
        .join(groups, "group")
        .select("list", "place", F.explode("sigs").alias("sig"))
    )
    by_group = groups.where(F.size("sigs") > 1).select(
        F.col("group").alias("list"), F.lit(0).alias("place"), F.explode("sigs").alias("sig")
    )
    met = stored(
        by_shingle.unionByName(by_group)
        .join(classes.select("sig", "n"), "sig")
        .select("list", "sig", "n", _tail(F.col("n"), F.col("place")).alias("tail"))
    )

    # First neighbours: by size, and in long lists also in random orders among like sizes.
    length = Window.partitionBy("list")
    band = F.floor(F.log("n") / F.log(F.lit(100 / PERCENT)))
    sized = met.withColumn("k", F.count("*").over(length)).withColumn("band", band)
    long = sized.where((F.col("k") > SHORT) & ((100 + PERCENT) * F.col("tail") >= 2 * PERCENT * F.col("n")))
    orders = [(sized, Window.partitionBy("list").orderBy("n", "sig"))]
    orders += [
        (long, Window.partitionBy("list", "band").orderBy(F.xxhash64("sig", F.lit(i)), "sig"))
        for i in range(CHAINS)
    ]
    pairs = [
        rows_.select(
            F.col("sig").alias("a"), "n", "tail",
            *[F.lead(c).over(w).alias(x) for c, x in (("sig", "b"), ("n", "m"), ("tail", "other"))],
        )
        for rows_, w in orders
    ]
    near = stored(
        reduce(DataFrame.unionByName, pairs)
        .where(F.col("b").isNotNull())
        .where(_may_link(*map(F.col, ("n", "m", "tail", "other"))))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    first = stored(_verified(rows, stored(_pruned(near, classes))))
    root = components(first)
    # Then what is still apart within a list.
    labelled = met.join(root, F.col("sig") == F.col("node"), "left").select(
        "list", "sig", "n", "tail", F.coalesce("root", "sig").alias("root")
    )
    mixed = labelled.groupBy("list").agg(F.count("*").alias("k"), F.min("root").alias("low"), F.max("root").alias("high"))
    apart = stored(labelled.join(mixed.where("k > 2 and low < high").select("list", "k"), "list"))
    rest = _across(apart, classes).join(near, ["a", "b"], "left_anti")
    second = stored(_verified(rows, stored(_pruned(rest, classes))))
    root = components(first.unionByName(second)) if not second.isEmpty() else root

    named = (
        members.join(root, F.col("sig") == F.col("node"), "left")
        .withColumn("class", F.when(F.col("n") > 0, F.col("sig")))
        .withColumn("component", F.when(F.col("n") > 0, F.coalesce("root", "sig")))
        .select("doc_id", "text_hash", "n", "class", "component")
    )
    lowest = named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("lowest"))
    return named.join(lowest, "component", "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "class", "component",
        F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents that stay, with all columns: of each component the one with the smallest id,
    and all with empty sets. Rows without an id come last; repeated rows stay once."""
    found = join(docs, text, key)
    ranked = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "text_hash")
    best = found.where("n_shingles > 0").groupBy("component").agg(F.min(ranked).alias("best")).select("best.doc_id", "best.text_hash")
    alone = found.where("n_shingles = 0").select("doc_id", "text_hash")
    chosen = best.unionByName(alone).distinct().toDF("_id", "_hash")
    hashed = docs.withColumn("_text_hash", text_hash(docs[text]))
    same = hashed[key].cast("long").eqNullSafe(chosen["_id"]) & (hashed["_text_hash"] == chosen["_hash"])
    return hashed.join(chosen, same, "left_semi").dropDuplicates([key, "_text_hash"]).drop("_text_hash")
