"""A random forest of regression trees, all trees of it grown a level at a time from blocks of binned rows.

The bins, gains, weights of rows and inputs per node are MLlib's ``RandomForestRegressor``'s in kind: rows are
drawn by Poisson weights, a node may be split by a third of the inputs, drawn anew for each. The draws are
others than MLlib's, whose own depend on the partitions, too. Weights are drawn again in each pass from the
partition and place of a block, so none are kept; a pass goes over the rows once for all trees, one pass a level.

Tables of up to LIBRARY_ROWS rows are left to MLlib, with its results.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.regression import RandomForestRegressor

from shelfcast.operators.binned import (
    LIBRARY_ROWS,
    Block,
    Blocks,
    BlockTrees,
    Node,
    Tree,
    best,
    flat,
    groups,
    halves_of,
)
from shelfcast.operators.tree_walk import TreesModel

MERGED = 4  # blocks that are added up at once
PAIRED = 1024  # bins of inputs that are counted together, at most
_NONE = 255  # place of rows that no node reads; weight of a cell that a step of the distribution divides


# --- draws --------------------------------------------------------------------------


def _steps() -> np.ndarray:
    """Distribution of the Poisson weights of mean 1, until it is 1 in double precision."""
    return np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])


def _cells(steps: np.ndarray) -> np.ndarray:
    """Weight by the first 16 bits of a uniform draw, where they settle it."""
    edges = np.arange((1 << 16) + 1) / (1 << 16)
    at = np.searchsorted(steps, edges, side="right")
    return np.where(at[:-1] == at[1:], at[:-1], _NONE).astype(np.uint8)


_STEPS = _steps()
_CELLS = _cells(_STEPS)


def poisson(draw: np.random.SFC64, n: int) -> np.ndarray:
    """Weights of n rows; draws that 16 bits do not settle get further bits."""
    bits = draw.random_raw(-(-n // 4)).view(np.uint16)[:n]
    weights = _CELLS.take(bits)
    open_ = np.flatnonzero(weights == _NONE)
    if len(open_):
        further = draw.random_raw(len(open_)).astype(float) / 2.0**64
        weights[open_] = np.searchsorted(_STEPS, (bits[open_] + further) / (1 << 16), side="right")
    return weights


def subset(seed: int, tree: int, depth: int, place: int, inputs: int, size: int) -> tuple[int, ...]:
    """Inputs that may split a node."""
    drawn = np.random.default_rng([seed, tree, depth, place]).choice(inputs, size, replace=False)
    return tuple(sorted(map(int, drawn)))


# --- a pass over the blocks ---------------------------------------------------------


def _merged(blocks: Iterable[Block]) -> Iterator[Block]:
    """Several blocks as one: calls of numpy cost as much as some thousand rows."""

    def joined(parts: list[Block]) -> Block:
        return np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts])

    parts: list[Block] = []
    for block in blocks:
        parts.append(block)
        if len(parts) == MERGED:
            yield joined(parts)
            parts = []
    if parts:
        yield joined(parts)


@dataclass(frozen=True)
class Wanted:
    """A node to be split, and the inputs that may split it."""

    tree: int
    place: int
    inputs: tuple[int, ...]


@dataclass(frozen=True)
class Pass:
    """Weights and weighted labels by bin of the nodes listed, for all trees."""

    bins: list[int]
    trees: list[Tree]
    wanted: list[Wanted]
    seed: int

    def __call__(self, index: int, blocks: Iterable[Block]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        together = [groups({f: self.bins[f] for f in w.inputs}, PAIRED) for w in self.wanted]
        sizes = [[math.prod(self.bins[f] for f in g) for g in own] for own in together]
        weighed = [[np.zeros(s) for s in own] for own in sizes]
        sums = [[np.zeros(s) for s in own] for own in sizes]
        by_tree: list[list[int]] = [[] for _ in self.trees]
        for i, w in enumerate(self.wanted):
            by_tree[w.tree].append(i)
        for number, (codes, labels) in enumerate(_merged(blocks)):
            draw = np.random.SFC64([self.seed, index, number])
            for tree, nodes in zip(self.trees, by_tree):
                weights = poisson(draw, len(labels))
                order, ends = self._ordered(tree, nodes, codes, weights)
                w = weights.take(order).astype(float)
                y = labels.take(order) * w
                for i, start, end in zip(nodes, [0, *ends], ends):
                    rows, own_w, own_y = order[start:end], w[start:end], y[start:end]
                    for g, features in enumerate(together[i]):
                        at = codes[features[0]].take(rows).astype(np.uint16)
                        for f in features[1:]:
                            at *= np.uint16(self.bins[f])
                            at += codes[f].take(rows)
                        weighed[i][g] += np.bincount(at, own_w, sizes[i][g])
                        sums[i][g] += np.bincount(at, own_y, sizes[i][g])
        yield self._by_input(together, weighed), self._by_input(together, sums)

    def _ordered(
        self, tree: Tree, nodes: list[int], codes: np.ndarray, weights: np.ndarray
    ) -> tuple[np.ndarray, list[int]]:
        """Drawn rows of the nodes, node by node, and where each node ends."""
        drawn = np.flatnonzero(weights)
        if len(tree.levels) == 1 or not nodes:
            return (drawn, [len(drawn)]) if nodes else (drawn[:0], [])
        slots = np.full(256, _NONE, np.uint8)
        slots[[self.wanted[i].place for i in nodes]] = np.arange(len(nodes))
        slot = slots.take(tree.places(codes).take(drawn))
        ends = np.bincount(slot, minlength=len(nodes))[: len(nodes)].cumsum().tolist()
        return drawn.take(np.argsort(slot, kind="stable")[: ends[-1]]), ends

    def _by_input(self, together: list[list[list[int]]], joint: list[list[np.ndarray]]) -> np.ndarray:
        out = np.zeros((len(self.wanted), len(self.wanted[0].inputs), max(self.bins)))
        for i, w in enumerate(self.wanted):
            for features, values in zip(together[i], joint[i]):
                table = values.reshape([self.bins[f] for f in features])
                for axis, f in enumerate(features):
                    others = tuple(a for a in range(table.ndim) if a != axis)
                    out[i, w.inputs.index(f), : self.bins[f]] = table.sum(axis=others)
        return out


def _added(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return a[0] + b[0], a[1] + b[1]


# --- the forest ---------------------------------------------------------------------


class RandomForest(BlockTrees):
    """Fits ``trees`` trees to rows drawn for each; their mean is the prediction."""

    def __init__(
        self, trees: int, seed: int, featuresCol: str, labelCol: str,
        depth: int = 5, bins: int = 32, library_rows: int = LIBRARY_ROWS,
        columns: Sequence[str] | None = None,
    ):
        super().__init__(seed, featuresCol, labelCol, depth, bins, library_rows, columns)
        self.trees = trees

    def library(self) -> RandomForestRegressor:
        return RandomForestRegressor(
            numTrees=self.trees, seed=self.seed, featuresCol=self.inputs, labelCol=self.label,
            maxDepth=self.depth, maxBins=self.bins,
        )

    def in_blocks(self, blocks: Blocks) -> TreesModel:
        trees = [Tree(1.0, [{0: Node(0.0)}]) for _ in range(self.trees)]
        bins = blocks.bins()
        size = len(bins) if self.trees == 1 else -(-len(bins) // 3)
        for depth in range(self.depth):
            wanted = [
                Wanted(t, place, subset(self.seed, t, depth, place, len(bins), size))
                for t, tree in enumerate(trees) if len(tree.levels) == depth + 1
                for place in sorted(tree.levels[-1])
            ]
            if not wanted:
                break
            weighed, sums = blocks.rows.mapPartitionsWithIndex(Pass(bins, trees, wanted, self.seed)).reduce(_added)
            below: list[dict[int, Node]] = [{} for _ in trees]
            for w, own in zip(wanted, zip(weighed, sums)):
                self._split(trees[w.tree], below[w.tree], w, own)
            for tree, level in zip(trees, below):
                if level:
                    tree.levels.append(level)
        return TreesModel(flat(trees, blocks.cuts, mean=True), self.inputs)

    def _split(self, tree: Tree, below: dict[int, Node], w: Wanted, own: tuple[np.ndarray, np.ndarray]) -> None:
        rows = own[0][0].sum()
        if not rows:  # no row drawn for the tree; its children always have some
            return
        split = best(*own)
        named = None if split is None else (w.inputs[split[0]], split[1])
        tree.levels[-1][w.place] = Node(own[1][0].sum() / rows, named)
        if split is not None:
            for side, (n, s) in enumerate(halves_of(own, split)):
                below[2 * w.place + side] = Node(s / n)
