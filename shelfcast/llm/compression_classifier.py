"""Quality by compression: dictionaries of good and of bad text, and a calibrated score.

Text compresses better with a dictionary built from its like. Two zstandard dictionaries are
built from labelled texts, one per class. A text is compressed with both in pieces of ``PIECE``
bytes, so that the dictionaries count for all of a long text; its feature is the difference of
the two compressed sizes over its own size. A logistic curve, fitted on other labelled texts,
turns it into a probability, given how frequent the classes are among all labels learned from.

Fitting reads a bounded sample: per class ``PER_CLASS`` labelled documents for the dictionaries
and as many for the curve, those with the smallest hash of their id, none longer than
``SAMPLE_CHARS`` characters. Scoring covers every whole text.

Defined results: a null or empty text has feature 0; repeated rows are scored row by row; of
several labels of one document the lowest counts; rows without a label, or with ids that are null,
are not learned from; without labels of both classes every score is 0.5. Label, language, source
and id are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.tables import map_batches

PER_CLASS = 1000
SAMPLE_CHARS = 30_000
DICTIONARY_BYTES = 110 << 10
PIECE = 1024
LEVEL = 3


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 4 == 2


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def scorer(self):
        if not self.good or not self.bad:
            return lambda text: 0.5
        sizes = [_sizer(d) for d in (self.good, self.bad)]

        def score(text: str) -> float:
            return _logistic(self.slope * _feature(sizes, text) + self.offset)

        return score


def _sizer(content: bytes):
    squeeze = zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=zstandard.ZstdCompressionDict(content),
        write_content_size=False,
        write_dict_id=False,
    ).compress
    return lambda pieces: sum([len(squeeze(piece)) for piece in pieces])


def _feature(sizes, text: str) -> float:
    raw = text.encode()
    if not raw:
        return 0.0
    pieces = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
    good, bad = sizes[0](pieces), sizes[1](pieces)
    return (bad - good) / len(raw)


def _logistic(x: float) -> float:
    return 1.0 / (1.0 + float(np.exp(-np.clip(x, -40.0, 40.0))))


def _dictionary(texts: list[str]) -> bytes:
    samples = [t.encode() for t in texts if t]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        # Too little text to choose from: its end serves as the dictionary.
        return b"\n".join(samples)[-DICTIONARY_BYTES:]


def _curve(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a light ridge.

    Classes weigh the same, and targets keep away from 0 and 1 as far as the sample is small.
    """
    positive, negative = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    goal = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    weight = np.where(y > 0, 0.5 / positive, 0.5 / negative)
    scale = float(x.std()) or 1.0
    design = np.column_stack([x / scale, np.ones(len(x))])
    beta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
        gradient = design.T @ (weight * (p - goal)) + 1e-5 * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-5 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= step * min(1.0, 5.0 / float(np.abs(step).max() + 1e-12))
        if float(np.abs(step).max()) < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def learnable(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One label per document that may be learned from."""
    return (
        labels.where(labels[key].isNotNull() & labels[label].isin(0, 1) & ~held_out(labels[key]))
        .groupBy(labels[key].alias("id"))
        .agg(F.min(labels[label]).alias("label"))
    )


def sample(docs: DataFrame, chosen: DataFrame, per_class: int, text: str, key: str) -> list[tuple]:
    """At most 2 * per_class (text, label, turn) of each class; ids are chosen from labels alone.

    An id with several texts gives the one of lowest hash, and Spark counts out each class, so the
    driver gets no more than that.
    """
    known = docs.select(docs[key].alias("id"), docs[text].alias("text"))
    by_id = (F.xxhash64("id"), F.col("id"))
    # Twice the number, as some may be missing or too long.
    ids = [chosen.where(F.col("label") == y).orderBy(*by_id).limit(4 * per_class) for y in (0, 1)]
    picked = known.join(F.broadcast(ids[0].unionByName(ids[1])), "id").where(
        F.length("text").between(1, SAMPLE_CHARS)
    )
    single = picked.groupBy("id", "label").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text")
    )
    place = F.row_number().over(Window.partitionBy("label").orderBy(*by_id))
    taken = single.withColumn("place", place).where(F.col("place") <= 2 * per_class)
    rows = taken.orderBy("label", "place").select("text", "label", "place").collect()
    return [(r["text"], r["label"], (r["place"] - 1) % 2) for r in rows]


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, text: str = "text", key: str = "doc_id", label: str = "quality",
) -> Model:
    chosen = learnable(labels, key, label)
    counts = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    rows = sample(docs, chosen, per_class, text, key)
    texts = {(y, turn): [t for t, b, c in rows if (b, c) == (y, turn)] for y in (0, 1) for turn in (0, 1)}
    if not all(texts.values()):
        return Model(b"", b"", 0.0, 0.0)
    good, bad = _dictionary(texts[1, 0]), _dictionary(texts[0, 0])
    sizes = [_sizer(good), _sizer(bad)]
    x = np.array([_feature(sizes, t) for y in (0, 1) for t in texts[y, 1]])
    y = np.repeat([0, 1], [len(texts[0, 1]), len(texts[1, 1])])
    slope, offset = _curve(x, y)
    return Model(good, bad, slope, offset + float(np.log(counts[1] / counts[0])))


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key and the probability that its label is 1."""

    def run(batch):
        scorer = model.scorer()
        texts = batch.column(1)
        yield {
            "doc_id": batch.column(0),
            "score": [scorer(texts[i].as_py() or "") for i in range(batch.num_rows)],
        }

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    return map_batches(rows, run, "doc_id long, score double")
