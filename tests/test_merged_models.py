"""Least squares from sums, autoregressions in columns, and trees walked in expressions."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from checks.queries import CUT
from shelfcast.operators import least_squares, tree_walk
from shelfcast.plans import autoregression, features, linear, models


@pytest.fixture(scope="module")
def table(inputs):
    built = features.retail_features(inputs.sales(), inputs.features(), inputs.stores()).cache()
    yield built
    built.unpersist()


def _numpy_line(x, y):
    return np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), y, rcond=None)[0]


def test_line_equals_the_library(table):
    model = models.fit(["linear_regression"], table, CUT)["linear_regression"]
    test = models.test_rows(table, CUT)
    library = model.transform(test).select("store", "dept", "date", "prediction")
    merged = linear.predict(table, CUT)
    off = F.abs(F.col("prediction") / F.col("predicted_weekly_sales") - 1)
    rows, worst = merged.join(library, ["store", "dept", "date"]).agg(F.count("*"), F.max(off)).first()
    assert rows == test.count() and worst < 1e-6


def _rows(spark, n=400, missing=0.2, seed=1):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(2000, 3, n), rng.normal(0, 1, n)
    y = 3 * a - 2 * b + rng.normal(0, 0.1, n)
    gone = rng.random(n) < missing
    rows = [(i, float(a[i]), None if gone[i] else float(b[i]), float(y[i])) for i in range(n)]
    rows.append((n, 1.0, 1.0, None))
    return spark.createDataFrame(rows, "i int, a double, b double, y double"), a, np.where(gone, np.nan, b), y


def test_missing_inputs_take_the_training_mean_of_each_part(spark):
    df, a, b, y = _rows(spark)
    given = least_squares.layout(df, ["a", "b"], ["b"], "y")
    parts = least_squares.products(df, given, F.when(F.col("i") < 250, 0).otherwise(1))
    line = least_squares.solve(given, parts[0])
    mean = np.nanmean(b[:250])
    filled = np.where(np.isnan(b), mean, b)
    expected = _numpy_line(np.column_stack([a, filled])[:250], y[:250])
    assert [*line.weights, line.intercept] == pytest.approx(expected, rel=1e-6)
    assert line.fills == {"b": pytest.approx(mean)} and line.rows == 250
    left = y[250:] - np.column_stack([a, filled, np.ones(len(a))])[250:] @ expected
    rows, rmse, r2 = least_squares.errors(line, parts[1])
    assert rows == 150 and rmse == pytest.approx(math.sqrt(np.mean(left**2)), rel=1e-6)
    assert r2 == pytest.approx(1 - np.sum(left**2) / np.sum((y[250:] - y[250:].mean()) ** 2), rel=1e-6)


def test_parts_add_up_and_pivots_change_nothing(spark):
    df, *_ = _rows(spark)
    given = least_squares.layout(df, ["a", "b"], ["b"], "y")
    whole = least_squares.products(df, given, F.lit(0))[0]
    thirds = least_squares.products(df, given, F.col("i") % 3)
    assert sum(thirds.values()) == pytest.approx(whole)
    other = least_squares.Layout(given.inputs, given.fillable, "y", {"a": 1990.0, "b": 5.0, "y": 0.0})
    one = least_squares.solve(given, whole)
    two = least_squares.solve(other, least_squares.products(df, other, F.lit(0))[0])
    assert one.weights == pytest.approx(two.weights, rel=1e-5)


def test_constant_and_repeated_inputs(spark):
    df = spark.createDataFrame([(1.0, float(i), float(i), 2.0 * i + 1) for i in range(20)], "c double, x double, z double, y double")
    given = least_squares.layout(df, ["c", "x", "z"], [], "y")
    line = least_squares.solve(given, least_squares.products(df, given, F.lit(0))[0])
    got = [r[0] for r in df.select(line.prediction()).collect()]
    assert got == pytest.approx([2.0 * i + 1 for i in range(20)]) and line.weights[0] == 0


def test_folds_equal_refits(table):
    """One scan for all folds against a model fitted for each."""
    first = dt.date(1997, 1, 3)
    merged = linear.cross_validate(table, first, folds=3).orderBy("fold").collect()
    refits = models.cross_validate("linear_regression", table, first, folds=3).orderBy("fold").collect()
    for m, r in zip(merged, refits, strict=True):
        assert (m["fold"], m["cut"], m["rows"]) == (r["fold"], r["cut"], r["rows"])
        assert m["rmse"] == pytest.approx(r["rmse"], rel=1e-6) and m["r2"] == pytest.approx(r["r2"], abs=1e-6)


def test_a_table_without_training_rows_gives_an_empty_line(spark, table):
    none = linear.cross_validate(table.limit(0), dt.date(1997, 1, 3), folds=1).first()
    assert none["rows"] == 0 and none["rmse"] is None


# ---------------------------------------------------------------------------------- autoregression


def _numpy_autoregression(y, horizon, max_order=2):
    models_ = []
    for d in (0, 1):
        x = np.diff(y, d)
        z, n = x - x.mean(), len(y) - 1
        c = [float(z[k:] @ z[: len(z) - k]) / len(z) for k in range(max_order + 1)]
        for p in range(max_order + 1):
            toeplitz = np.array([[c[abs(i - j)] for j in range(p)] for i in range(p)]).reshape(p, p)
            phi = np.linalg.solve(toeplitz, c[1 : p + 1]) if p else np.zeros(0)
            left, k = c[0] - phi @ np.array(c[1 : p + 1]), p + 1
            if n - k - 1 > 0:
                models_.append((n * math.log(left) + 2 * k + 2 * k * (k + 1) / (n - k - 1), d, p, phi, x.mean(), z))
    _, d, p, phi, mean, z = min(models_, key=lambda m: m[:3])
    values, level, out = list(z), y[-1], []
    for _ in range(horizon):
        values.append(sum(phi[i] * values[-1 - i] for i in range(p)))
        level = (level if d else 0.0) + mean + values[-1]
        out.append(level)
    return d, p, out


def test_autoregression_equals_numpy(spark, weekly):
    rng = np.random.default_rng(3)
    noise = rng.normal(0, 1, (6, 120))
    series = {}
    for i, phi in enumerate([(0.0, 0.0), (0.8, 0.0), (0.3, 0.5), (0.0, 0.0), (0.6, -0.3), (0.5, 0.2)]):
        x = [0.0, 0.0]
        for e in noise[i]:
            x.append(phi[0] * x[-1] + phi[1] * x[-2] + e)
        x = np.array(x[2:])
        series[1, i] = (100 + (np.cumsum(x) if i >= 3 else x)).tolist()
    got = autoregression.forecast_autoregression(weekly(series), horizon=9)
    seen = set()
    for (store, dept), y in series.items():
        own = got.filter((F.col("store") == store) & (F.col("dept") == dept)).orderBy("date").collect()
        d, p, expected = _numpy_autoregression(np.array(y), 9)
        seen.add((d, p))
        assert {(r["differences"], r["order"]) for r in own} == {(d, p)}
        assert [r["predicted_weekly_sales"] for r in own] == pytest.approx(expected)
    assert len(seen) > 2


def test_constant_short_and_straight_series(spark, weekly):
    given = {(1, 1): [5.0] * 40, (1, 2): [7.0], (1, 3): [float(3 * i) for i in range(40)], (1, 4): [1.0, 4.0, 2.0]}
    rows = autoregression.forecast_autoregression(weekly(given), horizon=3).orderBy("dept", "date").collect()
    by_dept = {d: [r["predicted_weekly_sales"] for r in rows if r["dept"] == d] for d in (1, 2, 3, 4)}
    assert by_dept[1] == [5.0] * 3 and by_dept[2] == [7.0] * 3
    assert by_dept[3] == pytest.approx([120.0, 123.0, 126.0]) and by_dept[4] == pytest.approx([2.0] * 3)


def test_autoregression_uses_no_python_and_one_shuffle(weekly):
    df = weekly({(1, 1): [1.0, 2.0, 4.0, 3.0] * 10})
    plan = autoregression.forecast_autoregression(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


# ------------------------------------------------------------------------------------------- trees


@pytest.mark.parametrize("name", ["random_forest", "gbt"])
def test_walked_trees_equal_the_model(table, name, monkeypatch):
    monkeypatch.setattr(models, "TREES", 7)
    monkeypatch.setattr(models, "ROUNDS", 5)
    filled, assembler, predictor = models.fit([name], table, CUT)[name].stages
    rows = PipelineModel([filled, assembler, predictor]).transform(models.test_rows(table, CUT))
    walk = tree_walk.trees_of(predictor).expression()
    inputs = F.array(*(F.col(c).cast("double") for c in models.INPUTS))
    off = F.abs(walk(inputs) / F.col("prediction") - 1)
    n, worst = rows.agg(F.count(off), F.max(off)).first()
    assert n == models.test_rows(table, CUT).count() > 0 and worst < 1e-12


def test_tree_horizon_is_one_pass(table, monkeypatch):
    """The fold gives what the written batches give, from a plan without any stored step."""
    monkeypatch.setattr(models, "ROUNDS", 4)
    fitted = models.fit(["gbt"], table, CUT)["gbt"]
    filled, assembler, predictor = fitted.stages
    folded = models.forecast_recursive(fitted, table, CUT, horizon=6)
    batches = models._batch_steps(
        PipelineModel([assembler, predictor]), models._start(filled, table, CUT), 6, every=2
    ).withColumnRenamed("predicted_weekly_sales", "p")
    off = F.abs(F.col("p") - F.col("predicted_weekly_sales"))
    rows, worst = folded.join(batches, ["store", "dept", "date"], "full").agg(F.count(off), F.max(off)).first()
    assert rows == folded.count() > 0 and worst < 1e-6
