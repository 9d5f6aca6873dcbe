"""Gradient boosted regression trees, their sums taken over blocks of binned rows.

Squared error, the bins, gains, order of ties and weights of MLlib's ``GBTRegressor``. MLlib keeps an
object per row and adds up all rows for every level of a tree; here a row is a byte per input and its
error, and a level reads the rows of the smaller child of each split only, as the other child is the
rest of its parent. Errors are rounded to a grid on which every sum is a whole number below 2^53, so
sums do not depend on the order or the partitions of the rows, and differences of sums are exact.

Tables of up to LIBRARY_ROWS rows are left to MLlib, which takes no longer there. Trees may differ where
splits of a few rows have the same gain: MLlib lets the last bit of its sums decide, here the first
input and cut win.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import RDD
from pyspark.ml.regression import GBTRegressor

from shelfcast.operators.binned import (
    KEPT,
    LIBRARY_ROWS,
    Block,
    Blocks,
    BlockTrees,
    Node,
    Sums,
    Tree,
    best,
    cuts_of,
    flat,
    groups,
    halves_of,
)
from shelfcast.operators.tree_walk import TreesModel

__all__ = ["BoostedTrees", "cuts_of"]

REFRESH = 3  # trees after which the errors are stored anew; until then each pass applies them


# --- a pass over the blocks ---------------------------------------------------------


def _left_over(codes: np.ndarray, errors: np.ndarray, done: list[Tree]) -> np.ndarray:
    for tree in done:
        errors = errors - (tree.weight * tree.values()).take(tree.places(codes))
    return errors


@dataclass(frozen=True)
class Pass:
    """Rows and errors by bin of the places listed, after the trees that are done.

    The first level also adds up the errors' sizes; it counts rows only if asked, as their bins stay the same.
    """

    bins: list[int]
    done: list[Tree]
    tree: Tree
    wanted: list[int]
    grid: float
    counted: bool

    def __call__(self, blocks: Iterable[Block]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        together, width, total = groups(dict(enumerate(self.bins))), len(self.wanted), 0.0
        sizes = [[width, *(self.bins[f] for f in g)] for g in together]
        counts = [np.zeros(math.prod(s), np.int64) for s in sizes]
        sums = [np.zeros(math.prod(s)) for s in sizes]
        root = len(self.tree.levels) == 1
        slots = np.full(1 << (len(self.tree.levels) - 1), -1, np.int32)
        slots[self.wanted] = np.arange(width)
        for codes, errors in blocks:
            slot = None
            if not root:
                slot = slots.take(self.tree.places(codes))
                picked = np.flatnonzero(slot >= 0)
                codes, errors, slot = codes.take(picked, axis=1), errors.take(picked), slot.take(picked)
            errors = _left_over(codes, errors, self.done)
            if root:
                total += float(np.abs(errors).sum())
            errors = np.rint(errors * self.grid)
            for g, features in enumerate(together):
                at = codes[features[0]].astype(np.uint16)
                for f in features[1:]:
                    at *= np.uint16(self.bins[f])
                    at += codes[f]
                if width > 1:
                    at = slot * np.int32(len(sums[g]) // width) + at
                if self.counted:
                    counts[g] += np.bincount(at, minlength=len(counts[g]))
                sums[g] += np.bincount(at, errors, minlength=len(sums[g]))
        yield self._by_input(together, sizes, counts), self._by_input(together, sizes, sums), total

    def _by_input(self, together: list[list[int]], sizes: list[list[int]], joint: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(self.wanted), len(self.bins), max(self.bins)), joint[0].dtype)
        for features, size, values in zip(together, sizes, joint):
            table = values.reshape(size)
            for axis, f in enumerate(features, start=1):
                others = tuple(a for a in range(1, table.ndim) if a != axis)
                out[:, f, : self.bins[f]] = table.sum(axis=others)
        return out


def _added(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


# --- trees --------------------------------------------------------------------------


class BoostedTrees(BlockTrees):
    """Fits ``rounds`` trees to what the ones before leave over."""

    last = True

    def __init__(
        self, rounds: int, seed: int, featuresCol: str, labelCol: str,
        depth: int = 5, bins: int = 32, rate: float = 0.1, library_rows: int = LIBRARY_ROWS,
        columns: Sequence[str] | None = None,
    ):
        super().__init__(seed, featuresCol, labelCol, depth, bins, library_rows, columns)
        self.rounds, self.rate = rounds, rate

    def library(self) -> GBTRegressor:
        return GBTRegressor(
            maxIter=self.rounds, seed=self.seed, featuresCol=self.inputs, labelCol=self.label,
            maxDepth=self.depth, maxBins=self.bins, stepSize=self.rate,
        )

    def in_blocks(self, blocks: Blocks) -> TreesModel:
        trees = self._boost(blocks.rows, blocks.bins(), blocks.bound)
        return TreesModel(flat(trees, blocks.cuts, mean=False), self.inputs)

    def _boost(self, blocks: RDD, bins: list[int], bound: float) -> list[Tree]:
        spent, counts = None, None
        trees, done = [], []
        try:
            for i in range(self.rounds):
                # What is left over is at most twice the labels, later 1 + 2 * rate times what it was.
                factor, weight = (2.0, self.rate) if i else (1.0, 1.0)
                grid = 2.0 ** (52 - math.frexp(factor * bound * 1.01)[1]) if bound else 1.0
                tree, total, counts = self._grow(blocks, bins, done, weight, factor, grid, counts)
                if spent is not None:  # the blocks that replace them have been read
                    spent.unpersist()
                    spent = None
                bound = total * (1 + 2 * self.rate) if i else 2 * total
                trees.append(tree)
                done.append(tree)
                if len(done) == REFRESH and i + 1 < self.rounds:
                    spent, blocks = blocks, _refreshed(blocks, done).persist(KEPT)
                    done = []
        finally:
            for each in (blocks, spent):
                if each is not None:
                    each.unpersist()
        return trees

    def _grow(
        self, blocks: RDD, bins: list[int], done: list[Tree], weight: float, factor: float, grid: float,
        known: np.ndarray | None,
    ) -> tuple[Tree, float, np.ndarray]:
        """A tree, the sum of the errors' sizes before it, and the rows by bin, counted unless known."""
        tree = Tree(weight, [{0: Node(0.0)}])
        given, wanted = {}, [0]  # sums of the parents' rest, and the places that a pass reads
        size = factor * grid
        first = None
        for depth in range(self.depth):
            counted = depth > 0 or known is None
            counts, sums, total = blocks.mapPartitions(Pass(bins, done, tree, wanted, size, counted)).reduce(_added)
            if not depth:
                known = counts if counted else known
                counts, first = known, total
            nodes: dict[int, Sums] = {p: (counts[i], sums[i]) for i, p in enumerate(wanted)}
            for p, parent in given.items():
                other = nodes[p ^ 1]
                nodes[p] = (parent[0] - other[0], parent[1] - other[1])
            below, given, wanted = {}, {}, []
            for p in sorted(nodes):
                own = nodes[p]
                rows, mean = own[0][0].sum(), own[1][0].sum() / own[0][0].sum() / grid
                split = best(*own)
                tree.levels[-1][p] = Node(mean, split)
                if split is None:
                    continue
                halves = halves_of(own, split)
                for side, (n, s) in enumerate(halves):
                    below[2 * p + side] = Node(s / n / grid)
                smaller = 0 if 2 * halves[0][0] <= rows else 1
                wanted.append(2 * p + smaller)
                given[2 * p + 1 - smaller] = own
            if not below:
                break
            tree.levels.append(below)
        return tree, first, known


def _refreshed(blocks: RDD, done: list[Tree]) -> RDD:
    trees = list(done)
    return blocks.map(lambda b: (b[0], _left_over(*b, trees)))
