"""Rows of a table as blocks of binned inputs, from which tree learners add up sums per bin.

MLlib's learners keep an object per row, with a weight per tree and row where a forest draws its rows. Here a
row is a byte per input and its label, and numpy adds up whole blocks. The cuts between bins are MLlib's, from
the rows that it samples for them; all rows are added up. Tables of up to LIBRARY_ROWS rows are left to MLlib.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.tree_walk import Trees

LIBRARY_ROWS = 1_000_000
BLOCK = 1 << 15  # rows of a block
JOINT = 2048  # bins of inputs that are counted together, at most
SAMPLE = 10_000  # rows that the cuts are taken from, as MLlib does; the trees see all rows

#: Kept as they reach Python: a serialized level would be read through Java's serializer by every pass.
KEPT = StorageLevel(True, True, False, True)

Block = tuple[np.ndarray, np.ndarray]  # a byte per input and row, and a label or error per row


# --- cuts and blocks ----------------------------------------------------------------


def cuts_of(values: np.ndarray, expected: float, bins: int) -> np.ndarray:
    """Cuts between sampled values; zeros count as many as the sample is expected to have."""
    given, counts = np.unique(values[values != 0], return_counts=True)
    if not len(given):
        return np.array([])
    counts = counts.astype(float)
    if (zeros := expected - counts.sum()) > 2.220446049250313e-16 * counts.sum() * 100:
        at = np.searchsorted(given, 0.0)
        given, counts = np.insert(given, at, 0.0), np.insert(counts, at, zeros)
    middles = (given[:-1] + given[1:]) / 2.0
    if len(middles) < bins:
        return middles
    stride = expected / bins
    cuts, seen, wanted = [], counts[0], stride
    for middle, count in zip(middles, counts[1:]):
        before, seen = seen, seen + count
        if abs(before - wanted) < abs(seen - wanted):
            cuts.append(middle)
            wanted += stride
    return np.array(cuts)


def _sampled(rows: DataFrame, fraction: float, seed: int) -> np.ndarray:
    """The inputs of about SAMPLE rows, the same ones that MLlib draws; all rows of a small table."""
    spark = rows.sparkSession
    if fraction < 1:
        draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        drawn = rows._jdf.toJavaRDD().sample(False, fraction, draw)
        rows = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark)
    return np.array([r[0] for r in rows.select("inputs").collect()], float)


def _binned(cuts: list[np.ndarray], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``label`` and ``inputs`` as one row per block."""

    def block(parts: list[Block]) -> pa.RecordBatch:
        codes = np.concatenate([p[0] for p in parts], axis=1)
        errors = np.concatenate([p[1] for p in parts])
        columns = [pa.array([a.tobytes()], pa.binary()) for a in (codes, errors)]
        return pa.RecordBatch.from_arrays(columns, names=["codes", "errors"])

    parts, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        labels = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        inputs = batch.column("inputs").flatten().to_numpy(zero_copy_only=False).reshape(len(labels), -1)
        if not (np.isfinite(labels).all() and np.isfinite(inputs).all()):
            raise ValueError("labels and inputs must be finite")
        codes = np.stack([np.searchsorted(c, inputs[:, j]) for j, c in enumerate(cuts)]).astype(np.uint8)
        parts.append((codes, labels))
        size += len(labels)
        if size >= BLOCK:
            yield block(parts)
            parts, size = [], 0
    if parts:
        yield block(parts)


def _blocks(rows: DataFrame, cuts: list[np.ndarray]) -> RDD:
    """Few partitions, as each sends its sums to the driver; tasks read them block by block."""
    context = rows.sparkSession.sparkContext
    few = rows.select("label", "inputs").coalesce(4 * context.defaultParallelism)
    stored = few.mapInArrow(partial(_binned, cuts), "codes binary, errors binary")
    inputs = len(cuts)
    return stored.rdd.map(
        lambda r: (np.frombuffer(r[0], np.uint8).reshape(inputs, -1), np.frombuffer(r[1], np.float64))
    )


@dataclass(frozen=True)
class Blocks:
    """The rows of a fit, the cuts of their inputs, and the sum of the labels' sizes."""

    rows: RDD
    cuts: list[np.ndarray]
    bound: float

    def bins(self) -> list[int]:
        return [len(c) + 1 for c in self.cuts]


@contextmanager
def blocks_of(
    dataset: DataFrame, label: str, inputs: str, columns: tuple[str, ...] | None, bins: int, seed: int
) -> Iterator[Blocks]:
    """Binned once and kept for the passes of the learners that read them.

    The columns that the vector of inputs is made of, where given, spare making it and taking it apart.
    """
    values = F.array(*columns) if columns else vector_to_array(inputs)
    rows = dataset.select(F.col(label).cast("double").alias("label"), values.alias("inputs"))
    n, bound = rows.agg(F.count(F.lit(1)), F.sum(F.abs("label"))).first()
    if not n or bound is None or not math.isfinite(bound):
        raise ValueError("there must be rows, with finite labels")
    bins = min(bins, n)
    fraction = min(1.0, max(bins * bins, SAMPLE) / n)
    sample = _sampled(rows, fraction, seed)
    cuts = [cuts_of(sample[:, j], fraction * n, bins) for j in range(sample.shape[1])]
    stored = _blocks(rows, cuts).persist(KEPT)
    try:
        yield Blocks(stored, cuts, bound)
    finally:
        stored.unpersist()


# --- trees --------------------------------------------------------------------------


@dataclass(frozen=True)
class Node:
    """Rows and mean label or error of a node, and the input and last bin that go left if it is split."""

    mean: float
    split: tuple[int, int] | None = None


@dataclass
class Tree:
    """Nodes by level and place; the children of a place are at twice it and one further."""

    weight: float
    levels: list[dict[int, Node]] = field(default_factory=list)

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Place of each row in the last level; rows of a leaf go on as to the left."""
        place = np.zeros(codes.shape[1], np.uint8)
        for level in self.levels[:-1]:
            right = np.zeros(codes.shape[1], bool)
            for at, node in level.items():
                if node.split is not None:
                    right |= (place == at) & (codes[node.split[0]] > node.split[1])
            place = place * np.uint8(2) + right
        return place

    def values(self) -> np.ndarray:
        """Mean by place in the last level."""
        last = len(self.levels) - 1
        out = np.zeros(1 << last)
        for depth, level in enumerate(self.levels):
            for at, node in level.items():
                if node.split is None:
                    out[at << (last - depth)] = node.mean
        return out


def groups(bins: dict[int, int], joint: int = JOINT) -> list[list[int]]:
    """Inputs that are counted together, as their joint bins are few; from the number of bins by input."""
    out: list[list[int]] = []
    size = joint
    for feature in sorted(bins, key=lambda f: bins[f]):
        if size * bins[feature] > joint:
            out.append([])
            size = 1
        out[-1].append(feature)
        size *= bins[feature]
    return out


Sums = tuple[np.ndarray, np.ndarray]  # rows and errors by input and bin


def best(counts: np.ndarray, sums: np.ndarray) -> tuple[int, int] | None:
    """The split of largest gain, the first input and cut among equal ones."""
    rows, total = counts[0].sum(), sums[0].sum()
    left, below = counts.cumsum(1), sums.cumsum(1)
    right, above = rows - left, total - below
    both = (left > 0) & (right > 0)
    left, right = np.where(both, left, 1), np.where(both, right, 1)
    apart = below / left - above / right
    gain = np.where(both, left / rows * (right / rows) * apart * apart, 0.0)
    at = int(gain.argmax())
    return divmod(at, counts.shape[1]) if gain.flat[at] > 0 else None


def halves_of(sums: Sums, split: tuple[int, int]) -> list[tuple[int, float]]:
    """Rows and sum of errors of both children."""
    feature, last = split
    halves = (slice(None, last + 1), slice(last + 1, None))
    return [(int(sums[0][feature, h].sum()), float(sums[1][feature, h].sum())) for h in halves]


def flat(trees: list[Tree], cuts: list[np.ndarray], mean: bool) -> Trees:
    out = Trees([], [t.weight for t in trees], [], [], [], [], [], depth=max(len(t.levels) for t in trees) - 1, mean=mean)

    def add(tree: Tree, depth: int, place: int) -> int:
        node, here = tree.levels[depth][place], len(out.feature)
        feature, last = node.split or (0, 0)
        out.feature.append(feature)
        out.cut.append(float(cuts[feature][last]) if node.split else 0.0)
        out.value.append(float(node.mean))
        out.left.append(here)
        out.right.append(here)
        if node.split:
            out.left[here] = add(tree, depth + 1, 2 * place)
            out.right[here] = add(tree, depth + 1, 2 * place + 1)
        return here

    for tree in trees:
        out.roots.append(add(tree, 0, 0))
    return out


class BlockTrees(Estimator):
    """A learner of trees: MLlib's over few rows, its own over blocks of many."""

    last = False  # whether it releases the blocks as it goes, so that others come first

    def __init__(
        self, seed: int, featuresCol: str, labelCol: str, depth: int, bins: int, library_rows: int,
        columns: Sequence[str] | None = None,
    ):
        super().__init__()
        self.seed, self.depth, self.bins = seed, depth, bins
        self.inputs, self.label, self.library_rows = featuresCol, labelCol, library_rows
        self.columns = tuple(columns) if columns else None

    def library(self) -> Estimator:
        raise NotImplementedError

    def in_blocks(self, blocks: Blocks) -> Model:
        raise NotImplementedError

    def _fit(self, dataset: DataFrame) -> Model:
        return fit_together({"": self}, dataset)[""]


def fit_together(learners: dict[str, BlockTrees], dataset: DataFrame) -> dict[str, Model]:
    """Fits learners that share their inputs, label, bins and seed; the rows are binned once for all."""
    n = dataset.count()
    fitted = {name: x.library().fit(dataset) for name, x in learners.items() if n <= x.library_rows}
    large = [name for name in learners if name not in fitted]
    if large:
        shared = {(x.label, x.inputs, x.columns, x.bins, x.seed) for x in map(learners.get, large)}
        if len(shared) > 1:
            raise ValueError("learners fitted together must share label, inputs, bins and seed")
        with blocks_of(dataset, *shared.pop()) as blocks:
            for name in sorted(large, key=lambda name: learners[name].last):
                fitted[name] = learners[name].in_blocks(blocks)
    return fitted
