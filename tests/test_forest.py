"""The forest in blocks against plain growth and MLlib's, and walks in Python against expressions."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegressionModel, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from checks.queries import CUT
from shelfcast.operators import binned, boosting, forest
from shelfcast.operators.least_squares import LeastSquares, LineModel
from shelfcast.operators.tree_walk import Trees, TreesModel, trees_of
from shelfcast.plans import features, models

COLUMNS = {"featuresCol": "inputs", "labelCol": "y"}


def _ready(spark, n=5000, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, k, n) * 1.0 for k in (9, 5, 7, 4)], axis=1)
    y = 500 * x[:, 0] * (x[:, 1] > 2) - 200 * x[:, 2] + rng.normal(0, 100, n)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y double").coalesce(1)
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="inputs").transform(df).select("inputs", "y")


def _in_blocks(ready, trees, **more):
    return forest.RandomForest(trees=trees, seed=42, library_rows=0, **COLUMNS, **more).fit(ready)


def _plain(codes, y, w, cuts, tree, depth, place, most):
    """A tree as nested tuples, grown row by row with the weights of the tree."""
    mean = (w * y).sum() / w.sum()
    found = None
    for f in forest.subset(42, tree, depth, place, len(cuts), 2) if depth < most else ():
        for last in range(len(cuts[f])):
            left = codes[f] <= last
            n, m = w[left].sum(), w[~left].sum()
            if n and m:
                apart = (w * y)[left].sum() / n - (w * y)[~left].sum() / m
                gain = n * m / (n + m) ** 2 * apart * apart
                if gain > 0 and (found is None or gain > found[0] * (1 + 1e-12)):
                    found = gain, f, last
    if found is None:
        return mean
    _, f, last = found
    sides = [codes[f] <= last, codes[f] > last]
    below = [_plain(codes[:, s], y[s], w[s], cuts, tree, depth + 1, 2 * place + i, most) for i, s in enumerate(sides)]
    return f, cuts[f][last], *below


def _nested(trees: Trees, at):
    if trees.left[at] == at:
        return trees.value[at]
    return trees.feature[at], trees.cut[at], _nested(trees, trees.left[at]), _nested(trees, trees.right[at])


def _same(a, b):
    if isinstance(a, tuple):
        return isinstance(b, tuple) and a[0] == b[0] and a[1] == b[1] and _same(a[2], b[2]) and _same(a[3], b[3])
    return not isinstance(b, tuple) and a == pytest.approx(b, rel=1e-9)


def test_trees_equal_plain_growth_from_the_same_draws(spark):
    ready = _ready(spark)
    own = _in_blocks(ready, 4, depth=3)
    data = ready.collect()
    x, y = np.array([r["inputs"].toArray() for r in data]).T, np.array([r["y"] for r in data])
    cuts = [binned.cuts_of(each, float(len(y)), 32) for each in x]
    codes = np.stack([np.searchsorted(c, each) for c, each in zip(cuts, x)])
    draw = np.random.SFC64([42, 0, 0])
    for tree, root in enumerate(own.trees.roots):
        w = forest.poisson(draw, len(y)).astype(float)
        drawn = w > 0
        expected = _plain(codes[:, drawn], y[drawn], w[drawn], cuts, tree, 0, 0, 3)
        assert _same(expected, _nested(own.trees, root))


def test_forest_in_blocks_predicts_as_well_as_the_library(spark):
    ready, unseen = _ready(spark).cache(), _ready(spark, seed=4)
    own, library = _in_blocks(ready.repartition(3), 40), RandomForestRegressor(numTrees=40, seed=42, **COLUMNS).fit(ready)
    error = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("y"), 2)))
    ours, theirs = (m.transform(unseen).agg(error).first()[0] for m in (own, library))
    assert len(own.trees.roots) == 40 and ours < 1.15 * theirs


def test_large_tables_grow_the_forest_in_blocks(inputs, monkeypatch):
    """Failed before: MLlib's forest keeps a weight per tree and row, whatever the table's size."""
    table = features.retail_features(inputs.sales(), inputs.features(), inputs.stores()).cache()
    monkeypatch.setattr(models, "TREES", 6)
    assert isinstance(models.fit(["random_forest"], table, CUT)["random_forest"].stages[-1], RandomForestRegressionModel)
    known = models.estimators()["random_forest"]
    known.library_rows = 0
    monkeypatch.setattr(models, "estimators", lambda: {"random_forest": known})
    fitted = models.fit(["random_forest"], table, CUT)["random_forest"]
    assert isinstance(fitted.stages[-1], TreesModel) and fitted.stages[-1].trees.mean
    ahead = models.forecast_recursive(fitted, table, CUT, horizon=3)
    series = table.filter(F.col("date") < F.lit(CUT)).select("store", "dept").distinct().count()
    assert ahead.count() == 3 * series and ahead.filter("predicted_weekly_sales is null").count() == 0


def test_learners_of_a_fit_share_blocks_of_rows_read_in_place(inputs, monkeypatch):
    """Failed before: each learner binned the rows of its own, and a stored table was stored again."""
    table = features.retail_features(inputs.sales(), inputs.features(), inputs.stores()).cache()
    alone = {}
    for name, size in (("TREES", 3), ("ROUNDS", 4)):
        monkeypatch.setattr(models, name, size)
    known = {name: each for name, each in models.estimators().items() if name != "linear_regression"}
    monkeypatch.setattr(models, "estimators", lambda: known)
    for each in known.values():
        each.library_rows = 0
    for name in known:
        alone[name] = models.fit([name], table, CUT)[name].stages[-1].trees
    binnings, stored = [], []
    blocks_of, stored_once = binned.blocks_of, models.stored_once
    monkeypatch.setattr(binned, "blocks_of", lambda *a: binnings.append(a) or blocks_of(*a))
    monkeypatch.setattr(models, "stored_once", lambda df: stored.append(df) or stored_once(df))
    models.fit(list(known), table, CUT, stored=True)
    assert len(binnings) == 1 and len(stored) == 1  # a small table is stored, for MLlib's order of rows
    monkeypatch.setattr(models, "LIBRARY_ROWS", 0)
    ready = table.coalesce(1).cache()
    both = models.fit(list(known), ready, CUT, stored=True)
    assert len(binnings) == 2 and len(stored) == 1
    for name, model in both.items():
        trees = model.stages[-1].trees
        assert len(trees.roots) == len(alone[name].roots) and trees.depth == alone[name].depth
    # The sums of boosted trees do not depend on the order of the rows.
    assert both["gbt"].stages[-1].trees.feature == alone["gbt"].feature


def test_columns_give_the_blocks_of_their_vector(spark):
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="inputs").transform(
        spark.createDataFrame([(float(i % 7), -1.5 * i, float(i)) for i in range(300)], "a double, b double, y double")
    )
    trees = [
        boosting.BoostedTrees(rounds=3, seed=1, library_rows=0, columns=c, **COLUMNS).fit(ready).trees
        for c in (None, ["a", "b"])
    ]
    assert trees[0] == trees[1]
    missing = ready.withColumn("a", F.when(F.col("y") > 5, F.col("a")))
    with pytest.raises(Exception, match="must be finite"):
        boosting.BoostedTrees(rounds=3, seed=1, library_rows=0, columns=["a", "b"], **COLUMNS).fit(missing)


def test_weights_follow_the_distribution():
    steps = forest._STEPS
    settled = forest._CELLS != forest._NONE
    assert settled.mean() > 0.999 and np.array_equal(
        forest._CELLS[settled], np.searchsorted(steps, np.flatnonzero(settled) / (1 << 16), side="right")
    )
    weights = forest.poisson(np.random.SFC64([1, 2, 3]), 1_000_001)
    shares = np.bincount(weights, minlength=8)[:8] / len(weights)
    assert np.allclose(shares, np.diff([0.0, *steps[:8]]), atol=2e-3) and weights.max() < 20
    assert np.array_equal(weights, forest.poisson(np.random.SFC64([1, 2, 3]), 1_000_001))


@pytest.mark.parametrize("mean", [True, False])
def test_walk_in_python_gives_the_bits_of_the_expression(spark, mean):
    rng = np.random.default_rng(9)
    trees = Trees([0, 3], [1.0, 0.1], [0, 0, 0, 1, 0, 0, 0], [0.3, 0.0, 0.0, 0.7, 0.0, -0.2, 0.0],
                  [1, 1, 2, 4, 4, 5, 6], [2, 1, 2, 5, 4, 6, 6], [0.0, 0.1, 0.7, 0.0, -3.3, 1e9, 2.2], 2, mean)
    given = [[float(v) for v in row] for row in rng.normal(0, 1, (40, 2))]
    given += [[None, 0.7], [float("nan"), None], [-0.0, 0.0]]
    rows = spark.createDataFrame([(g,) for g in given], "inputs array<double>")
    expected = [r[0] for r in rows.select(trees.expression()(F.col("inputs"))).collect()]
    given = np.array([[np.nan if v is None else v for v in g] for g in given]).T
    assert trees.predict(given).tolist() == expected


@pytest.mark.parametrize("name", ["random_forest", "linear_regression"])
def test_recursion_in_python_gives_the_bits_of_the_fold(spark, weekly, inputs, monkeypatch, name):
    """Short series and unknown sales among the newest, which count as 0 in lags and leave no mean."""
    monkeypatch.setattr(models, "TREES", 6)
    table = features.retail_features(inputs.sales(), inputs.features(), inputs.stores()).cache()
    filled, _, predictor = models.fit([name], table, CUT)[name].stages
    df = weekly({(1, 1): [2e4, 3e4, None, 9e4], (1, 2): [4e4], (2, 1): [None], (3, 1): [5e4] * 9, (3, 2): [1e4, None]},
                first=dt.date(2000, 10, 6))
    for held in models.HELD:
        df = df.withColumn(held, F.lit(1.5) * F.col("store"))
    df = df.withColumn("isholidayencoded", F.when(F.col("dept") != 2, 1.0))
    state = models._start(filled, df, CUT).cache()

    def by_tree(moving):
        walk = trees_of(predictor).expression()
        return models._named(F.array(*[moving.get(c, F.col(c)).cast("double") for c in models.INPUTS]), walk)

    def by_weights(moving):
        weight = dict(zip(models.INPUTS, predictor.coefficients.tolist()))
        value = F.lit(float(predictor.intercept))
        for c in [*models.SERIES, *models.HELD, *moving]:
            if c in weight:
                value = value + moving.get(c, F.col(c)).cast("double") * weight[c]
        return value

    def used(moving):  # the fold offers these in the order in which a line adds them
        kept = {c: moving[c] for c in moving if c in models.INPUTS}
        return by_tree(kept) if name == "random_forest" else by_weights(kept)

    steps = models._tree_steps if name == "random_forest" else models._linear_steps
    fold = models._fold_steps(state, 60, used)
    paths = [{(r["store"], r["dept"]): list(r["path"]) for r in d.collect()} for d in (steps(predictor, state, 60), fold)]
    assert paths[0] == paths[1] and len(paths[0]) == 5 and all(len(p) == 60 for p in paths[0].values())
    if name == "linear_regression":
        assert None in paths[0][1, 1] and None not in paths[0][3, 1]


def test_many_rows_get_their_line_from_one_pass(spark):
    """Failed before: MLlib read the rows twice and as objects, whatever their number."""
    rng = np.random.default_rng(2)
    x = rng.normal(0, 3, (400, 3)) + [1e3, 0, -50]
    y = x @ [2.0, -1.0, 0.5] + 7 + rng.normal(0, 1, 400)
    rows = [(*map(float, a), 4.0, float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y double").repartition(5)
    ready = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="inputs").transform(df).cache()
    library, own = (LeastSquares(["a", "b", "c", "d"], library_rows=n, **COLUMNS).fit(ready) for n in (400, 399))
    assert isinstance(library, LinearRegressionModel) and isinstance(own, LineModel)
    exact = np.linalg.lstsq(np.column_stack([x, np.ones(400)]), y, rcond=None)[0]
    assert [*own.coefficients[:3], own.intercept] == pytest.approx(exact, rel=1e-8) and own.coefficients[3] == 0
    # A constant input makes MLlib iterate, up to its tolerance.
    both = own.transform(library.transform(ready).withColumnRenamed("prediction", "p"))
    n, worst = both.agg(F.count("prediction"), F.max(F.abs(F.col("p") - F.col("prediction")))).first()
    assert n == 400 and worst < 1e-3 and "values" not in both.columns
    with pytest.raises(Exception, match="must be finite"):
        LeastSquares(["a"], library_rows=0, **COLUMNS).fit(ready.withColumn("a", F.when(F.col("b") > 0, F.col("a"))))
