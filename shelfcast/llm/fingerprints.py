"""Bottom-k sketches of word shingles: mergeable fingerprints of documents.

A sketch keeps the ``k`` smallest hashes of a text's distinct five-word shingles. Sketches of
parts merge into the sketch of the whole, and a pair of sketches estimates resemblance,
containment and the number of distinct shingles. A text with at most ``k`` shingles is kept
whole, so its estimates are exact.

A fingerprint is the sketch as text: base64 of the sorted 64-bit hashes. Words are compared
with A-Z folded. Equal texts have equal fingerprints; a null or empty text, or one without
words, has the empty fingerprint, and two empty fingerprints have likeness 1.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import blocks
from shelfcast.llm.tables import arrow_schema, map_batches

#: Hashes of a sketch; the standard error of a resemblance r is sqrt(r * (1 - r) / K).
K = 128
_FULL = float(2**64)
_LOWEST = -(2**63)


def sketches(texts: pa.Array, k: int = K) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for _, _, data, offsets in blocks.text_blocks(texts):
        out += [s[:k].copy() for s in blocks.shingle_sets(blocks.Words(data, offsets))]
    return out


def to_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u8")


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of what both sketches stand for."""
    return np.union1d(a, b)[:k]


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    if len(a) < k:
        return float(len(a))
    return (k - 1) / ((float(a[k - 1]) + 1) / _FULL)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated intersection over union: the common share of the union's smallest hashes."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(common <= union[-1])) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b holds too."""
    if not len(a):
        return 1.0
    union = distinct_shingles(merge(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct_shingles(a, k))


def fingerprint(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = K) -> DataFrame:
    """Per row: key, fingerprint and estimated number of distinct shingles."""

    def run(batch):
        found = sketches(batch.column(1), k)
        yield {
            "doc_id": batch.column(0),
            "fingerprint": [to_text(s) for s in found],
            "n_shingles": [distinct_shingles(s, k) for s in found],
        }

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    return map_batches(rows, run, "doc_id long, fingerprint string, n_shingles double")


def merged(prints: DataFrame, *by: str, k: int = K) -> DataFrame:
    """One fingerprint per group: the k smallest of all its rows' hashes.

    Rows are salted over partitions first and merged there, so that a hot group arrives as a few
    sketches, never as its rows.
    """
    groups = prints.select(*by, "fingerprint")

    def part(batch):
        frame = batch.to_pandas()
        keys, prints_ = [], []
        for group, rows in frame.groupby(list(by), dropna=False, sort=False):
            total = np.zeros(0, np.uint64)
            for value in rows["fingerprint"]:
                total = merge(total, from_text(value), k)
            keys.append(group)
            prints_.append(to_text(total))
        yield {name: [g[i] for g in keys] for i, name in enumerate(by)} | {"fingerprint": prints_}

    schema = groups.schema.simpleString()[7:-1].replace(":", " ")
    width = 16
    once = map_batches(groups, part, schema)
    salted = once.withColumn("salt", F.abs(F.hash("fingerprint")) % width)

    def fold(table: pa.Table) -> pa.Table:
        total = np.zeros(0, np.uint64)
        for value in table.column("fingerprint").to_pylist():
            total = merge(total, from_text(value), k)
        first = table.slice(0, 1)
        return pa.table({n: first.column(n) for n in by} | {"fingerprint": pa.array([to_text(total)])})

    partial = salted.groupBy(*by, "salt").applyInArrow(fold, schema)
    return partial.groupBy(*by).applyInArrow(fold, schema)


# ---------------------------------------------------------------- each document and its next


def _ranges(ids: DataFrame, parts: int) -> tuple[list[int], dict[int, int]]:
    """Bounds of about ``parts`` ranges of ids, and the highest id of each range that has rows.

    Both are at most ``parts`` numbers; a null id counts as the lowest.
    """
    ids = ids.select(F.coalesce("doc_id", F.lit(_LOWEST)).alias("id"))
    shares = [i / parts for i in range(1, parts)]
    found = ids.select(F.percentile_approx("id", shares, 10_000).alias("q")).first()["q"] if shares else []
    bounds = sorted(set(found or []))

    def highest(batch):
        values = batch.column(0).to_numpy()
        where = np.searchsorted(bounds, values)
        tops = [values[where == w].max() for w in np.unique(where)]
        yield {"range": np.unique(where).astype(np.int32), "top": np.array(tops, np.int64)}

    tops = map_batches(ids, highest, "range int, top long").groupBy("range").agg(F.max("top").alias("top"))
    return bounds, {r["range"]: r["top"] for r in tops.collect()}


def with_next(docs: DataFrame, schema: str, compute, parts: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Applies ``compute(ids, texts, next texts)`` to documents in descending order of key.

    The document after the last is the first. Texts move once, compressed, to ranges of keys;
    each range also gets the first document of the range that follows it, so that a task sees
    every neighbour and streams through its range. Rows with equal keys follow one another in
    the order of their texts; a null key comes last.
    """
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    bounds, tops = _ranges(rows, parts)
    order = sorted(tops, reverse=True)
    # The first document of each range is the guest of the range before it.
    guest_of = {tops[b]: a for a, b in zip(order, order[1:] + order[:1], strict=True)}

    def pack(batch):
        ids = [_LOWEST if i is None else i for i in batch.column(0).to_pylist()]
        ranges = np.searchsorted(bounds, ids).tolist()
        squeeze = zstandard.ZstdCompressor(level=1).compress
        out = {"range": [], "guest": [], "doc_id": [], "body": []}
        for i, (id_, text_) in enumerate(zip(ids, batch.column(1), strict=True)):
            body = squeeze((text_.as_py() or "").encode())
            for where, guest in ((ranges[i], 0), (guest_of.get(id_), 1)):
                if where is not None:
                    out["range"].append(where)
                    out["guest"].append(guest)
                    out["doc_id"].append(batch.column(0)[i].as_py())
                    out["body"].append(body)
        yield out

    moved = (
        map_batches(rows, pack, "range int, guest int, doc_id long, body binary")
        .repartition(parts, "range")
        .sortWithinPartitions("range", "guest", F.col("doc_id").desc_nulls_last(), F.md5("body"))
    )
    target = arrow_schema(schema)

    def stream(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        held = None  # (bucket, id, text) that waits for its next document
        ids, texts, nexts, size = [], [], [], 0
        for batch in batches:
            for bucket_, guest, id_, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text_ = unpack(body).decode()
                if held is not None and held[0] == bucket_:
                    ids.append(held[1])
                    texts.append(held[2])
                    nexts.append(text_)
                    size += len(held[2])
                # Only the first guest follows; a guest itself is another range's document.
                held = (bucket_, id_, text_) if not guest else None
                if size > blocks.BLOCK_BYTES:
                    yield pa.RecordBatch.from_pydict(compute(ids, texts, nexts), schema=target)
                    ids, texts, nexts, size = [], [], [], 0
        if ids:
            yield pa.RecordBatch.from_pydict(compute(ids, texts, nexts), schema=target)

    return moved.mapInArrow(stream, schema)


def edited(text: str, after: str) -> str:
    """The text with its last third replaced by as many code points of the next text."""
    n = len(text) // 3
    return text[: len(text) - n] + after[:n]


def edit_likeness(docs: DataFrame, parts: int, k: int = K) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness."""

    def compute(ids, texts, nexts):
        changed = [edited(t, a) for t, a in zip(texts, nexts, strict=True)]
        n = len(texts)
        # Most next texts are the following row's own; only the others are sketched once more.
        apart = [i for i in range(n) if i + 1 == n or nexts[i] is not texts[i + 1]]
        found = sketches(pa.array(texts + changed + [nexts[i] for i in apart], pa.large_string()), k)
        own, other, after = found[:n], found[n : 2 * n], found[1 : n + 1]
        for i, sketch in zip(apart, found[2 * n :], strict=True):
            after[i] = sketch
        return {
            "doc_id": ids,
            "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": [to_text(s) for s in own],
            "edited_fingerprint": [to_text(s) for s in other],
            "near_edited": [resemblance(a, b, k) for a, b in zip(own, other, strict=True)],
            "near_next": [resemblance(a, b, k) for a, b in zip(own, after, strict=True)],
        }

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return with_next(docs, schema, compute, parts)
