"""Fitted tree ensembles as arrays of nodes, walked by column expressions or by numpy.

A model transformer needs its inputs as columns of a DataFrame, so a forecast that feeds predictions
back into its inputs takes one transformation per step. As arrays the same trees can be walked many
times in one pass: by an expression, a node at a time, or in Python workers, all rows of a batch at once,
which is much faster. Both compare and add up in the same order, so they give the same bits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import scratch_path


def _constant(values: list, kind: str) -> Column:
    """An array as one literal, which the optimizer folds; a literal per element is slow to build."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


@dataclass(frozen=True)
class Trees:
    """All nodes of all trees, one after the other; a leaf's children are itself."""

    roots: list[int]
    weights: list[float]
    feature: list[int]
    cut: list[float]
    left: list[int]
    right: list[int]
    value: list[float]
    depth: int
    mean: bool  # a forest's trees vote for a mean, boosted ones add up

    def expression(self) -> Callable[[Column], Column]:
        """Prediction as a function of an array of the inputs in order."""
        feature, left, right, roots = (_constant(x, "int") for x in (self.feature, self.left, self.right, self.roots))
        cut, value, weights = (_constant(x, "double") for x in (self.cut, self.value, self.weights))
        levels = F.sequence(F.lit(1), F.lit(self.depth)) if self.depth else F.array().cast("array<int>")

        def predicted(inputs: Column) -> Column:
            def down(node: Column, _: Column) -> Column:
                goes_left = F.get(inputs, F.get(feature, node)) <= F.get(cut, node)
                return F.when(goes_left, F.get(left, node)).otherwise(F.get(right, node))

            votes = F.transform(roots, lambda root: F.get(value, F.aggregate(levels, root, down)))
            summed = F.aggregate(F.zip_with(weights, votes, lambda w, v: w * v), F.lit(0.0), lambda s, x: s + x)
            return summed / sum(self.weights) if self.mean else summed

        return predicted

    def predict(self, inputs: np.ndarray) -> np.ndarray:
        """Predictions of rows given as an array per input; missing values (NaN) go right, as nulls do above."""
        feature, roots = np.array(self.feature), np.array(self.roots)
        children = np.array([self.right, self.left])
        cut, value = np.array(self.cut), np.array(self.value)
        rows, given, count = np.arange(inputs.shape[1]), np.ascontiguousarray(inputs).ravel(), len(feature)
        start, children = feature * inputs.shape[1], children.ravel()
        total = np.zeros(inputs.shape[1])
        for root, weight in zip(roots, self.weights):
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                goes_left = given.take(start.take(node) + rows) <= cut.take(node)
                node = children.take(node + goes_left * count)
            total += weight * value.take(node)
        return total / sum(self.weights) if self.mean else total


def by_input(rows: pa.Array) -> np.ndarray:
    """Lists of equal length as an array per place; nulls become NaN."""
    values = rows.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.ascontiguousarray(values.reshape(len(rows), -1).T) if len(rows) else np.empty((0, 0))


class TreesModel(Model):
    """Trees as a stage of a pipeline, with the prediction of a vector of inputs."""

    def __init__(self, trees: Trees, featuresCol: str):
        super().__init__()
        self.trees, self.inputs = trees, featuresCol

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = self.trees

        @F.arrow_udf("double")
        def predicted(inputs: pa.Array) -> pa.Array:
            return pa.array(trees.predict(by_input(inputs)) if len(inputs) else [], pa.float64())

        return dataset.withColumn("prediction", predicted(vector_to_array(self.inputs)))


def trees_of(model: RandomForestRegressionModel | GBTRegressionModel | TreesModel) -> Trees:
    """Reads the nodes of a fitted forest or boosted ensemble; categorical splits are not supported.

    The nodes of MLlib's come from the model as it saves itself: trees times 2^(depth + 1) rows at most.
    """
    if isinstance(model, TreesModel):
        return model.trees
    spark = SparkSession.active()
    path = scratch_path(spark)
    model.write().save(path)
    by_tree: dict[int, dict[int, Row]] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        by_tree.setdefault(row["treeID"], {})[row["id"]] = row
    out = Trees(
        [], list(map(float, model.treeWeights)), [], [], [], [], [],
        depth=max(t.depth for t in model.trees),
        mean=isinstance(model, RandomForestRegressionModel),
    )
    for tree in sorted(by_tree):
        nodes = by_tree[tree]
        first = len(out.feature)
        place = {number: first + i for i, number in enumerate(sorted(nodes))}
        out.roots.append(place[0])
        for number in sorted(nodes):
            n, here = nodes[number], place[number]
            inner = n["leftChild"] >= 0
            if inner and n["split"]["numCategories"] != -1:
                raise ValueError("categorical splits are not supported")
            out.feature.append(n["split"]["featureIndex"] if inner else 0)
            out.cut.append(float(n["split"]["leftCategoriesOrThreshold"][0]) if inner else 0.0)
            out.left.append(place[n["leftChild"]] if inner else here)
            out.right.append(place[n["rightChild"]] if inner else here)
            out.value.append(float(n["prediction"]))
    return out
