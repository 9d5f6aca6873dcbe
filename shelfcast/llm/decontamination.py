"""Benchmark decontamination by winnowing.

Texts are words; a window is ``width`` consecutive ones. Of every window only the smallest hash of its
k-grams is kept, its fingerprint. The fingerprint depends on nothing but the window's content, and
neighbouring windows mostly share theirs, so few distinct fingerprints stand for all windows, and every
shared span of ``width`` words or more has one in common. Training and test fingerprints are joined, and
a hit is extended over the windows that the fingerprint stands for: those whose whole content the test
side knows are contaminated. Window contents are compared by 64-bit hashes of 64-bit word hashes.

An item of fewer words is one window of its own length and its own fingerprint.

The training side is read once. A bitmap of fixed size over the test fingerprints, sent to all tasks,
keeps most training fingerprints from being shuffled; it may let others through, never the reverse. The
join key is (fingerprint, window), distinct on the test side, so a passage that many items and many
documents share makes one row per document window, not one per pair of document and item. Documents
that hold the same set of windows share one list of items.

Defined results: null or empty texts have no words, hits or items; an item without words cannot occur.
Items are told apart by id: rows that repeat an id count as one item, whose windows are those of all
its rows, and a null id is listed as an empty string. Every document row has its own result, so repeated
ids and rows are kept. Without items no document is contaminated. Further columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import blocks
from shelfcast.llm.tables import map_batches, stored

#: Words of a window, and of the k-grams whose smallest hash stands for it.
WIDTH = 10
GRAM = 5
#: Bits of the map of test fingerprints; tasks hold it whole (1 MB).
MAP_BITS = 23

_ASCII_WORD = np.zeros(256, bool)
_ASCII_WORD[0x30:0x3A] = _ASCII_WORD[0x41:0x5B] = _ASCII_WORD[0x61:0x7B] = True
_ASCII_WORD[0x80:] = True

_READ = "row binary, key bigint, n_words bigint, hits array<struct<fp:bigint,win:bigint,len:int,start:bigint>>"


class Windows:
    """Windows of a block of texts: document, first word, length, content and fingerprint."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int, gram: int):
        self.words = blocks.Words(data, offsets, _ASCII_WORD)
        self.bounds = self.words.bounds
        self.values = self.words.hashes(lower=True)
        n = len(self.values)
        self.width = width
        fits = np.maximum(np.diff(self.bounds) - width + 1, 0)
        self.doc = np.repeat(np.arange(len(fits)), fits)
        self.start = np.repeat(self.bounds[:-1] - np.cumsum(fits) + fits, fits) + np.arange(fits.sum())
        self.fp = np.zeros(0, np.uint64)
        self.sums = blocks.Prefix(self.values)
        if not len(self.start):
            return
        best = self.sums.hash(np.s_[: n - gram + 1], np.s_[gram:])
        reach, span = width - gram + 1, 1
        while 2 * span <= reach:
            best = np.minimum(best[:-span], best[span:])
            span *= 2
        if span < reach:
            best = np.minimum(best[: span - reach], best[reach - span :])
        self.fp = best[self.start]

    def contents(self, chosen: np.ndarray) -> np.ndarray:
        """Hashes of the whole windows at these indexes."""
        at = self.start[chosen]
        return self.sums.hash(at, at + self.width) if len(at) else np.zeros(0, np.uint64)

    def short(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, first word and hash of all sequences of so many words."""
        fits = np.maximum(np.diff(self.bounds) - length + 1, 0)
        doc = np.repeat(np.arange(len(fits)), fits)
        start = np.repeat(self.bounds[:-1] - np.cumsum(fits) + fits, fits) + np.arange(fits.sum())
        if not len(start):
            return doc, start, np.zeros(0, np.uint64)
        return doc, start, blocks.mix(self.sums.hash(start, start + length) ^ np.uint64(length))


def _bits(values: np.ndarray) -> np.ndarray:
    return (blocks.mix(values) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def item_windows(items: DataFrame, key: str, text: str, width: int, gram: int) -> DataFrame:
    """Distinct (item, fingerprint, window, length) of the test side."""

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = batch.column(0)
        for first, last, data, offsets in blocks.text_blocks(batch.column(1)):
            found = Windows(data, offsets, width, gram)
            counts = np.diff(found.bounds)
            own = ids.slice(first, last - first)
            win = found.contents(np.arange(len(found.start)))
            parts = [(found.doc, found.fp, win, np.full(len(win), width))]
            for length in range(1, width):
                doc, _, hashed = found.short(length)
                alone = counts[doc] == length
                parts.append((doc[alone], hashed[alone], hashed[alone], np.full(int(alone.sum()), length)))
            doc, fp, win, size = (np.concatenate(p) for p in zip(*parts, strict=True))
            yield {
                "item": own.take(pa.array(doc)), "fp": fp.view(np.int64), "win": win.view(np.int64),
                "len": size.astype(np.int32),
            }

    rows = items.select(F.coalesce(items[key].cast("string"), F.lit("")), items[text])
    return map_batches(rows, cut, "item string, fp bigint, win bigint, len int").distinct()


def fingerprint_map(windows: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over the fingerprints; its words merge by bitwise or."""

    def mark(batch: pa.RecordBatch) -> Iterator[dict]:
        bits = np.unique(_bits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
        yield {"at": bits >> 6, "word": (np.uint64(1) << (bits & 63).astype(np.uint64)).view(np.int64)}

    marked = map_batches(windows.select("fp"), mark, "at bigint, word bigint")
    rows = marked.groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()  # 2^17 rows at most
    words = np.zeros((1 << MAP_BITS) >> 6, np.uint64)
    words[rows["at"].to_numpy()] = rows["word"].to_numpy().view(np.uint64)
    return np.unpackbits(words.view(np.uint8), bitorder="little")


def _row_names(count: int) -> pa.Array:
    """Fresh names; a row keeps its own because the table is written before it is used."""
    return pa.Array.from_buffers(pa.binary(16), count, [None, pa.py_buffer(os.urandom(16 * count))]).cast(pa.binary())


def _candidates(docs: DataFrame, key: str, text: str, known: np.ndarray, lengths: list[int], width: int, gram: int):
    """A row per document: its words, and the windows whose fingerprint the map knows."""
    context = docs.sparkSession.sparkContext
    sent = context.broadcast(np.packbits(known))

    def probe(batch: pa.RecordBatch) -> Iterator[dict]:
        bits = np.unpackbits(sent.value).view(bool)
        names = _row_names(batch.num_rows)
        for first, last, data, offsets in blocks.text_blocks(batch.column(1)):
            found = Windows(data, offsets, width, gram)
            # Neighbouring windows share their fingerprint: only changes are looked up.
            new = np.ones(len(found.fp), bool)
            new[1:] = found.fp[1:] != found.fp[:-1]
            hit = np.repeat(
                bits[_bits(found.fp[new])], np.diff(np.append(np.flatnonzero(new), len(new)))
            )
            chosen = np.flatnonzero(hit)
            parts = [(found.doc[chosen], found.start[chosen], found.fp[chosen], found.contents(chosen), width)]
            for length in lengths:
                doc, start, hashed = found.short(length)
                hit = bits[_bits(hashed)]
                parts.append((doc[hit], start[hit], hashed[hit], hashed[hit], length))
            size = np.concatenate([np.full(len(p[0]), p[4], np.int32) for p in parts])
            doc, start, fp, win = (np.concatenate([p[i] for p in parts]) for i in range(4))
            order = np.argsort(doc, kind="stable")
            doc, start, fp, win, size = (a[order] for a in (doc, start, fp, win, size))
            rows = last - first
            ends = np.searchsorted(doc, np.arange(rows + 1))
            hits = pa.StructArray.from_arrays(
                [
                    pa.array(fp.view(np.int64)), pa.array(win.view(np.int64)), pa.array(size),
                    pa.array(start - found.bounds[doc]),
                ],
                ["fp", "win", "len", "start"],
            )
            yield {
                "row": names.slice(first, rows),
                "key": batch.column(0).slice(first, rows),
                "n_words": np.diff(found.bounds),
                "hits": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), hits),
            }

    return stored(map_batches(docs.select(docs[key].cast("long"), docs[text]), probe, _READ))


def _covered(spans: str):
    """Words under sorted (start, end) spans."""
    step = lambda acc, s: F.struct(
        F.greatest(acc["end"], s["end"]).alias("end"),
        (acc["n"] + F.greatest(s["end"] - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("n"),
    )
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    gram: int = GRAM,
) -> DataFrame:
    """Per document row: its words, the merged (start, end) word spans that items share, the items."""
    test = stored(item_windows(items, item_key, item_text, width, gram))
    lengths = sorted(r["len"] for r in test.select("len").distinct().collect() if r["len"] < width)
    read = _candidates(docs, key, text, fingerprint_map(test), lengths, width, gram)
    known = test.select("fp", "win", "len").distinct()
    found = read.select("row", F.explode("hits").alias("hit")).select("row", "hit.*").join(known, ["fp", "win", "len"])
    # A document's windows meet in one row: at most its own words.
    per_row = stored(
        found.groupBy("row").agg(
            F.sort_array(
                F.collect_set(F.struct(F.col("start"), (F.col("start") + F.col("len")).alias("end")))
            ).alias("spans"),
            F.sort_array(F.collect_set(F.struct("win", "len"))).alias("windows"),
        ).withColumn("held", F.md5(F.to_json(F.struct("windows"))))
    )
    listed = (
        per_row.groupBy("held").agg(F.first("windows").alias("windows"))
        .select("held", F.explode("windows").alias("w")).select("held", "w.win", "w.len")
        .join(test.select("win", "len", "item"), ["win", "len"])
        .groupBy("held").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    hits = per_row.select("row", "spans", "held").join(listed, "held")
    return (
        read.select("row", "key", "n_words").join(hits, "row", "left")
        .select(
            F.col("key").alias(key), "n_words",
            F.coalesce(_covered("spans"), F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )
