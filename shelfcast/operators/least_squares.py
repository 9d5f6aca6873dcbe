"""Linear least squares from sums of products that merge.

One hash aggregate gives, per part of the data, the sums of all products of inputs, label, a constant
and marks of missing inputs, combined in each task before they move. Parts add up, so training sets that grow over time are prefix sums, and
missing inputs can be filled with the mean of any training set afterwards: the sums say what the fill
changes. The same sums give the errors of a fit on other parts. What reaches the driver depends on the
number of parts and inputs, never on the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.binned import LIBRARY_ROWS


@dataclass(frozen=True)
class Layout:
    """Names of the inputs, those that may be missing, the label, and a value near each column's mean.

    The pivots only keep the sums small; any values give the same fit.
    """

    inputs: tuple[str, ...]
    fillable: tuple[str, ...]
    label: str
    pivots: Mapping[str, float]

    def terms(self) -> list[Column]:
        shifted = [
            F.coalesce(F.col(c).cast("double") - self.pivots[c], F.lit(0.0)) for c in (*self.inputs, self.label)
        ]
        missing = [F.when(F.col(c).isNull(), 1.0).otherwise(0.0) for c in self.fillable]
        return [F.lit(1.0), *shifted[:-1], *missing, shifted[-1]]


def layout(df: DataFrame, inputs: Sequence[str], fillable: Sequence[str], label: str) -> Layout:
    """Takes the pivots from any one row."""
    row = df.select(*inputs, label).first()
    pivots = {c: float(row[c] or 0.0) if row else 0.0 for c in (*inputs, label)}
    return Layout(tuple(inputs), tuple(fillable), label, pivots)


def products(df: DataFrame, given: Layout, part: Column) -> dict[int, np.ndarray]:
    """Matrix of summed products per part, from one aggregate; rows without label don't count.

    Each row becomes a row per term, which adds the products with all terms to that term's sums: code
    for all products at once would be too long to be compiled.
    """
    size = len(given.terms())
    known = df.filter(F.col(given.label).isNotNull()).select(part.alias("part"), F.array(*given.terms()).alias("t"))
    one_term = known.select("part", "t", F.posexplode("t").alias("i", "x"))
    sums = one_term.groupBy("part", "i").agg(F.array(*(F.sum(F.col("x") * F.col("t")[j]) for j in range(size))))
    found: dict[int, np.ndarray] = {}
    for part_, i, row in sums.collect():  # parts times terms
        found.setdefault(part_, np.zeros((size, size)))[i] = row
    return found


@dataclass(frozen=True)
class Line:
    """A fitted line; ``fills`` replace missing inputs."""

    given: Layout
    weights: np.ndarray
    intercept: float
    fills: Mapping[str, float]
    rows: int

    def prediction(self) -> Column:
        value = F.lit(self.intercept)
        for name, weight in zip(self.given.inputs, self.weights.tolist(), strict=True):
            column = F.col(name).cast("double")
            column = F.coalesce(column, F.lit(self.fills[name])) if name in self.fills else column
            value = value + column * weight
        return value


def _filled(given: Layout, matrix: np.ndarray, fills: Mapping[str, float]) -> np.ndarray:
    """Products of constant, inputs and label after filling with these values."""
    width = len(given.inputs)
    into = np.zeros((width + 2, len(matrix)))
    into[: width + 1, : width + 1] = np.eye(width + 1)
    into[-1, -1] = 1.0
    for k, name in enumerate(given.fillable):
        into[given.inputs.index(name) + 1, width + 1 + k] = fills[name] - given.pivots[name]
    return into @ matrix @ into.T


def solve(given: Layout, matrix: np.ndarray) -> Line:
    """Least squares over the rows behind a matrix; inputs that never vary get weight 0."""
    rows = matrix[0, 0]
    width = len(given.inputs)
    fills = {}
    for k, name in enumerate(given.fillable):
        seen = rows - matrix[0, width + 1 + k]
        mean = matrix[0, given.inputs.index(name) + 1] / seen if seen else 0.0
        fills[name] = mean + given.pivots[name]
    full = _filled(given, matrix, fills)
    means = full[0, 1:] / max(rows, 1)
    centred = full[1:, 1:] - rows * np.outer(means, means)
    spread = np.sqrt(np.maximum(np.diag(centred)[:-1], 0))
    size = np.sqrt(np.maximum(np.diag(full)[1:-1], 0))
    varies = spread > 1e-7 * np.maximum(size, 1e-300)
    weights = np.zeros(width)
    if varies.any():
        scale = spread[varies]
        left = centred[:-1, :-1][np.ix_(varies, varies)] / np.outer(scale, scale)
        right = centred[:-1, -1][varies] / scale
        try:
            lower = np.linalg.cholesky(left)
            solved = np.linalg.solve(lower.T, np.linalg.solve(lower, right))
        except np.linalg.LinAlgError:  # inputs that repeat one another: the smallest weights
            solved = np.linalg.lstsq(left, right, rcond=1e-12)[0]
        weights[varies] = solved / scale
    raw = means + [given.pivots[c] for c in (*given.inputs, given.label)]
    return Line(given, weights, float(raw[-1] - weights @ raw[:-1]), fills, int(rows))


def errors(line: Line, matrix: np.ndarray) -> tuple[int, float | None, float | None]:
    """Rows, RMSE and R² of a line on the rows behind a matrix."""
    given = line.given
    full = _filled(given, matrix, line.fills)
    rows = full[0, 0]
    if not rows:
        return 0, None, None
    pivots = np.array([given.pivots[c] for c in given.inputs])
    shifted = line.intercept + line.weights @ pivots - given.pivots[given.label]
    residual = np.concatenate([[-shifted], -line.weights, [1.0]])
    squares = max(float(residual @ full @ residual), 0.0)
    total = full[-1, -1] - full[0, -1] ** 2 / rows
    return int(rows), float(np.sqrt(squares / rows)), float(1 - squares / total) if total > 0 else None


# --- the same line as a stage of a pipeline ------------------------------------------


def _batch_products(pivots: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One matrix per task: products of a constant, the inputs and the label, whose rows are known."""
    total = np.zeros((len(pivots) + 1, len(pivots) + 1))
    for batch in batches:
        if batch.num_rows:
            labels = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            inputs = batch.column("inputs").flatten().to_numpy(zero_copy_only=False).reshape(len(labels), -1)
            terms = np.column_stack([np.ones(len(labels)), inputs, labels])
            terms[:, 1:] -= pivots
            total += terms.T @ terms
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])


class LineModel(Model):
    """A fitted line as a stage of a pipeline, with the prediction of a vector of inputs."""

    def __init__(self, coefficients: np.ndarray, intercept: float, featuresCol: str):
        super().__init__()
        self.coefficients, self.intercept, self.inputs = DenseVector(coefficients), intercept, featuresCol

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = F.lit(0.0)
        for i, weight in enumerate(self.coefficients.tolist()):
            value = value + F.get(F.col("values"), F.lit(i)) * weight
        given = dataset.withColumn("values", vector_to_array(self.inputs))
        return given.withColumn("prediction", value + self.intercept).drop("values")


class LeastSquares(Estimator):
    """MLlib's linear regression over few rows; over many, the line from one pass of matrix products.

    MLlib reads the rows twice, for its sums and for a summary that is not used here, and each as an object.
    """

    def __init__(self, columns: Sequence[str], featuresCol: str, labelCol: str, library_rows: int = LIBRARY_ROWS):
        super().__init__()
        self.columns, self.inputs, self.label, self.library_rows = tuple(columns), featuresCol, labelCol, library_rows

    def _fit(self, dataset: DataFrame) -> LineModel | LinearRegressionModel:
        if dataset.count() <= self.library_rows:
            return LinearRegression(featuresCol=self.inputs, labelCol=self.label).fit(dataset)
        given = layout(dataset, self.columns, [], self.label)
        pivots = np.array([given.pivots[c] for c in (*self.columns, self.label)])
        rows = dataset.select(
            F.col(self.label).cast("double").alias("label"), F.array(*self.columns).alias("inputs")
        )
        parts = rows.mapInArrow(lambda batches: _batch_products(pivots, batches), "sums binary").collect()
        size = len(pivots) + 1
        matrix = sum((np.frombuffer(p["sums"]).reshape(size, size) for p in parts), np.zeros((size, size)))
        if not np.isfinite(matrix).all():
            raise ValueError("labels and inputs must be finite")
        line = solve(given, matrix)
        return LineModel(line.weights, line.intercept, self.inputs)
