"""Boosted trees in blocks against MLlib's."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from checks.queries import CUT
from shelfcast.operators import boosting, tree_walk
from shelfcast.operators.tree_walk import TreesModel
from shelfcast.plans import features, models

COLUMNS = {"featuresCol": "inputs", "labelCol": "y"}


def _ready(spark, n=6000, seed=5):
    """Few values per input, so that no split has just a few rows and gains differ."""
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, k, n) * 1.5 - 2 for k in (5, 4, 3, 3)], axis=1)
    y = 1000 * x[:, 0] * x[:, 1] - 300 * x[:, 2] + rng.normal(0, 400, n)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y double")
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="inputs").transform(df).select("inputs", "y")


def _in_blocks(ready, rounds=12):
    return boosting.BoostedTrees(rounds=rounds, seed=42, library_rows=0, **COLUMNS).fit(ready)


def test_blocks_give_the_trees_of_the_library(spark):
    ready = _ready(spark).repartition(3).cache()
    own, library = _in_blocks(ready), GBTRegressor(maxIter=12, seed=42, **COLUMNS).fit(ready)
    assert isinstance(own, TreesModel) and len(own.trees.roots) == 12
    both = library.transform(ready).withColumnRenamed("prediction", "p")
    off = F.abs(F.col("p") - F.col("prediction"))
    n, worst = own.transform(both).agg(F.count(off), F.max(off)).first()
    assert n == 6000 and worst < 1e-3
    expected = tree_walk.trees_of(library)
    assert own.trees.feature == expected.feature and own.trees.cut == pytest.approx(expected.cut)


def test_trees_do_not_depend_on_partitions(spark):
    ready = _ready(spark).cache()
    assert _in_blocks(ready.repartition(1), 7).trees == _in_blocks(ready.repartition(5), 7).trees


def test_large_tables_are_fitted_in_blocks(inputs, monkeypatch):
    table = features.retail_features(inputs.sales(), inputs.features(), inputs.stores()).cache()
    monkeypatch.setattr(models, "ROUNDS", 6)
    assert isinstance(models.fit(["gbt"], table, CUT)["gbt"].stages[-1], GBTRegressionModel)
    known = models.estimators()["gbt"]
    monkeypatch.setattr(known, "library_rows", 0)
    monkeypatch.setattr(models, "estimators", lambda: {"gbt": known})
    fitted = models.fit(["gbt"], table, CUT)["gbt"]
    assert isinstance(fitted.stages[-1], TreesModel)
    ahead = models.forecast_recursive(fitted, table, CUT, horizon=3)
    series = table.filter(F.col("date") < F.lit(CUT)).select("store", "dept").distinct().count()
    assert ahead.count() == 3 * series and ahead.filter("predicted_weekly_sales is null").count() == 0


def test_zeros_count_as_expected_and_constants_have_no_cuts():
    values = np.array([0.0, 0.0, 1.0, 2.0])
    assert boosting.cuts_of(values, 4.0, 4).tolist() == [0.5, 1.5]
    assert boosting.cuts_of(np.zeros(5), 5.0, 4).tolist() == []
    assert boosting.cuts_of(np.full(5, 3.0), 5.0, 4).tolist() == []
    assert len(boosting.cuts_of(np.arange(1.0, 101.0), 100.0, 8)) == 7


def test_constant_labels_give_one_leaf_a_tree(spark):
    ready = _ready(spark, 50).withColumn("y", F.lit(3.0))
    own = _in_blocks(ready, 3)
    assert own.trees.depth == 0 and own.transform(ready).filter("prediction <> 3").count() == 0


def test_labels_must_be_finite(spark):
    with pytest.raises(ValueError):
        _in_blocks(_ready(spark, 50).withColumn("y", F.lit(float("nan"))))
