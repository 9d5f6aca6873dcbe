"""Regression models over the feature table: training, choice, direct and recursive forecasts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import (
    GBTRegressionModel,
    LinearRegressionModel,
    RandomForestRegressionModel,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from shelfcast.functions.columns import calendar
from shelfcast.operators.binned import LIBRARY_ROWS, BlockTrees, fit_together
from shelfcast.operators.boosting import BoostedTrees
from shelfcast.operators.cleaning import SERIES, as_date, before, one_row_per_key
from shelfcast.operators.forest import RandomForest
from shelfcast.operators.least_squares import LeastSquares, LineModel
from shelfcast.operators.series import future_frame, spread
from shelfcast.operators.tree_walk import TreesModel, by_input, trees_of
from shelfcast.plans.baselines import recent_values
from shelfcast.session import scratch, scratch_path, small_tasks, stored_once

LABEL = "weekly_sales"

# The model inputs, model sizes and seed.
LAGS = ["weekly_sales_lag1", "weekly_sales_rolling4", "weekly_sales_lag2", "weekly_sales_lag3"]
CONDITIONS = [
    "total_markdown", "temperature", "fuel_price",
    "cpi_scaled", "unemployment_scaled", "fuel_price_scaled", "size",
]
CALENDAR = ["week", "month", "year"]
INPUTS = ["store", "dept", "isholidayencoded", *CONDITIONS, *CALENDAR, *LAGS]
TREES = 50
ROUNDS = 50
SEED = 42

# Values of a series that stay at their last known level in the future.
HELD = ["isholidayencoded", *CONDITIONS]


def estimators(seed: int = SEED) -> dict[str, Estimator]:
    columns = {"featuresCol": "inputs", "labelCol": LABEL}
    return {
        "random_forest": RandomForest(trees=TREES, seed=seed, columns=INPUTS, **columns),
        "gbt": BoostedTrees(rounds=ROUNDS, seed=seed, columns=INPUTS, **columns),
        "linear_regression": LeastSquares(INPUTS, **columns),
    }


def model_inputs(features: DataFrame) -> DataFrame:
    """Key, label and inputs as doubles; a missing lag is 0."""
    typed = {c: F.col(c).cast("double") for c in INPUTS if c not in SERIES}
    typed.update({c: F.coalesce(typed[c], F.lit(0.0)) for c in LAGS})
    label = [LABEL] if LABEL in features.columns else []
    return features.withColumns(typed).select(*SERIES, "date", *label, *INPUTS[2:])


@contextmanager
def kept(df: DataFrame, stored: bool = False) -> Iterator[DataFrame]:
    """Keeps a frame for the repeated passes of a fit, in files of bounded size that are tasks of their own.

    What a tree learner keeps per row takes the executors' memory by itself, in partitions of the
    tasks that read the frame; in memory the frame would crowd it out. Many rows of a stored table
    are read where they are, as their trees take few passes over them.
    """
    spark = df.sparkSession
    with scratch(spark), small_tasks(spark):
        yield df if stored and df.count() > LIBRARY_ROWS else stored_once(df)


def fit(
    names: list[str], features: DataFrame, cut: dt.date | str, stored: bool = False
) -> dict[str, PipelineModel]:
    """Models on the rows before the cut, which are computed once for all of them.

    Each result fills missing conditions with their training mean, assembles the inputs and
    predicts. ``stored`` says that the features come from ``session.stored_once``.
    """
    filler = Imputer(inputCols=CONDITIONS, outputCols=CONDITIONS, strategy="mean")
    assembler = VectorAssembler(inputCols=INPUTS, outputCol="inputs")
    known_sales = before(features, cut).filter(F.col(LABEL).isNotNull())
    with kept(model_inputs(known_sales), stored) as train:
        filled = filler.fit(train)
        ready = assembler.transform(filled.transform(train)).select(LABEL, "inputs", *INPUTS)
        known = {name: each for name, each in estimators().items() if name in names}
        trees = {name: each for name, each in known.items() if isinstance(each, BlockTrees)}
        fitted = fit_together(trees, ready) if trees else {}
        fitted.update({name: each.fit(ready) for name, each in known.items() if name not in trees})
        return {name: PipelineModel([filled, assembler, fitted[name]]) for name in names}


def test_rows(features: DataFrame, cut: dt.date | str, until: dt.date | str | None = None) -> DataFrame:
    later = features.filter(F.col("date") >= as_date(cut))
    return model_inputs(later if until is None else before(later, until))


def predict(name: str, features: DataFrame, cut: dt.date | str, stored: bool = False) -> DataFrame:
    """Rows from the cut on with the prediction of a model fitted before it."""
    model = fit([name], features, cut, stored)[name]
    return model.transform(test_rows(features, cut)).select(
        *SERIES, "date", LABEL, F.col("prediction").alias("predicted_weekly_sales")
    )


def regression_metrics(scored: DataFrame, actual: str, predicted: str, by: list[str]) -> DataFrame:
    """RMSE and R² in one aggregate."""
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    squares, spread = F.sum(e * e), F.var_pop(y) * F.count(y)
    return (
        scored.filter(y.isNotNull() & F.col(predicted).isNotNull())
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
            F.when(spread > 0, 1 - squares / spread).alias("r2"),
        )
    )


def compare(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """Held-out RMSE and R² of each model; the lowest RMSE is best, R² breaks ties.

    The models come from one ``fit`` and share its preparation, so the test rows are read and
    prepared once and get a prediction column per model.
    """
    scored = test
    for stage in next(iter(models.values())).stages[:-1]:
        scored = stage.transform(scored)
    for name, model in models.items():
        scored = model.stages[-1].transform(scored).withColumnRenamed("prediction", name)
    one = [F.struct(F.lit(n).alias("model"), F.col(n).alias("prediction")) for n in models]
    metrics = regression_metrics(
        scored.select(LABEL, F.inline(F.array(*one))), LABEL, "prediction", by=["model"]
    )
    # One row per model, so the window without partition key is tiny.
    order = Window.orderBy(F.col("rmse"), F.col("r2").desc())
    return metrics.withColumn("is_best", F.when(F.row_number().over(order) == 1, 1).otherwise(0))


def best_model(models: dict[str, PipelineModel], test: DataFrame) -> str:
    """Name of the best model on rows that none of them was fitted on."""
    return compare(models, test).filter(F.col("is_best") == 1).first()["model"]


def cross_validate(
    name: str, features: DataFrame, first_cut: dt.date, folds: int = 3, weeks: int = 13
) -> DataFrame:
    """Folds in time order: train before a cut, score the weeks after it, move the cut on."""
    scored = []
    for fold in range(folds):
        cut = first_cut + dt.timedelta(weeks=weeks * fold)
        model = fit([name], features, cut)[name]
        test = test_rows(features, cut, cut + dt.timedelta(weeks=weeks))
        scored.append(
            model.transform(test).select(
                F.lit(fold + 1).alias("fold"), F.lit(cut).alias("cut"), LABEL, "prediction"
            )
        )
    return regression_metrics(
        reduce(DataFrame.unionByName, scored), LABEL, "prediction", by=["fold", "cut"]
    )


def forecast_direct(
    model: PipelineModel,
    features: DataFrame,
    cut: dt.date | str,
    last: dt.date | str,
    conditions: DataFrame | None = None,
) -> DataFrame:
    """Every future week in one pass, with the lags of the last known row.

    ``conditions``, one row per store and date with any of the held columns, replace the last
    known values of the weeks they cover.
    """
    future = future_frame(before(features, cut), [*HELD, *LAGS], cut, last)
    if conditions is not None:
        given = [c for c in HELD if c in conditions.columns]
        known = one_row_per_key(conditions.select("store", "date", *given), ["store", "date"])
        known = known.withColumnsRenamed({c: f"given_{c}" for c in given})
        future = future.join(known, ["store", "date"], "left").withColumns(
            {c: F.coalesce(f"given_{c}", c) for c in given}
        )
    return model.transform(model_inputs(future)).select(
        *SERIES, "date", F.col("prediction").alias("predicted_weekly_sales")
    )


# --- recursive forecast -------------------------------------------------------------

_RECENT = 4  # weeks that the lags and the rolling mean reach back


def _no_path() -> Column:
    return F.array().cast("array<double>")


def _start(filled: Model, features: DataFrame, cut: dt.date | str) -> DataFrame:
    """One row per series: last date, newest sales first, and the held conditions."""
    with small_tasks(features.sparkSession):  # each task sorts what it reads
        newest = stored_once(recent_values(before(features, cut), _RECENT, LABEL, also=HELD))
    typed = spread(newest).withColumns({c: F.col(c).cast("double") for c in HELD})
    return filled.transform(typed).withColumn("path", _no_path())


def _lag_inputs(recent: Column) -> dict[str, Column]:
    total = F.aggregate(recent, F.lit(0.0), lambda s, x: s + x)
    lags = {f"{LABEL}_lag{i}": F.coalesce(F.get(recent, F.lit(i - 1)), F.lit(0.0)) for i in (1, 2, 3)}
    return {**lags, f"{LABEL}_rolling4": total / F.size(recent)}


def _push(prediction: Column, recent: Column) -> Column:
    return F.slice(F.concat(F.array(prediction), recent), 1, _RECENT)


def _unroll(state: DataFrame, done: Column | int = 0) -> DataFrame:
    """A row per predicted week; ``done`` weeks come before those of the path."""
    weeks = done if isinstance(done, Column) else F.lit(done)
    # The outer form: the plain one adds a filter on the path, which computes it twice.
    return state.select(*SERIES, "last_date", weeks.alias("done"), F.posexplode_outer("path")).select(
        *SERIES,
        F.expr("date_add(last_date, 7 * (done + pos + 1))").alias("date"),
        F.col("col").alias("predicted_weekly_sales"),
    )


def forecast_recursive(
    model: PipelineModel, features: DataFrame, cut: dt.date | str, horizon: int = 52, every: int = 4
) -> DataFrame:
    """Predict one week of all series at once, feed it back into the lags, repeat.

    The state is one row per series and a step needs no shuffle. Linear models and trees take the
    whole horizon in one pass through Python workers. For any other model the state is written every
    few steps with their predictions, and the next steps start from what was written without them.
    """
    filled, assembler, predictor = model.stages
    state = _start(filled, features, cut)
    if isinstance(predictor, LinearRegressionModel | LineModel):
        return _unroll(_linear_steps(predictor, state, horizon))
    if isinstance(predictor, RandomForestRegressionModel | GBTRegressionModel | TreesModel):
        return _unroll(_tree_steps(predictor, state, horizon))
    return _batch_steps(PipelineModel([assembler, predictor]), state, horizon, every)


def _batch_steps(scorer: PipelineModel, state: DataFrame, horizon: int, every: int) -> DataFrame:
    spark = state.sparkSession
    folder = scratch_path(spark)
    for step in range(1, horizon + 1):
        fields = calendar(F.expr(f"date_add(last_date, {7 * step})"))
        inputs = {**{c: fields[c].cast("double") for c in CALENDAR}, **_lag_inputs(F.col("recent"))}
        prediction = F.col("prediction")
        state = scorer.transform(state.withColumns(inputs)).select(
            *SERIES, "last_date", *HELD,
            _push(prediction, F.col("recent")).alias("recent"),
            F.concat("path", F.array(prediction)).alias("path"),
        )
        if step % every == 0 or step == horizon:
            batch = f"{folder}/done={(step - 1) // every * every}"
            state.write.parquet(batch)
            state = spark.read.schema(state.schema).parquet(batch).withColumn("path", _no_path())
    every_batch = StructType([*state.schema.fields, StructField("done", IntegerType())])
    written = spark.read.schema(every_batch).parquet(folder)
    return _unroll(written, F.col("done"))


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """Computes a value once for an expression that uses it several times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _fold_steps(
    state: DataFrame, horizon: int, predicted: Callable[[dict[str, Column]], Column]
) -> DataFrame:
    """The recursion as one expression over the horizon; ``predicted`` takes the moving inputs."""

    def advance(now: Column, step: Column) -> Column:
        fields = calendar(F.date_add(F.col("last_date"), 7 * step))
        moving = {**{c: fields[c] for c in CALENDAR}, **_lag_inputs(now["recent"])}
        return _named(
            predicted(moving),
            lambda p: F.struct(
                _push(p, now["recent"]).alias("recent"),
                F.concat(now["path"], F.array(p)).alias("path"),
            ),
        )

    steps = F.sequence(F.lit(1), F.lit(horizon))
    return state.withColumn("path", F.aggregate(steps, F.struct("recent", "path"), advance)["path"])


def _calendar_of(day: np.ndarray) -> dict[str, np.ndarray]:
    """The fields of CALENDAR as ``calendar`` has them; a missing day has none."""
    thursday = day + (3 - (day.astype(int) + 3) % 7)
    year = thursday.astype("datetime64[Y]").astype("datetime64[D]")
    fields = {
        "week": (thursday - year).astype(int) // 7 + 1,
        "month": day.astype("datetime64[M]").astype(int) % 12 + 1,
        "year": day.astype("datetime64[Y]").astype(int) + 1970,
    }
    return {name: np.where(np.isnat(day), np.nan, value) for name, value in fields.items()}


_MOVING = [*CALENDAR, *(f"{LABEL}_lag{i}" for i in (1, 2, 3)), f"{LABEL}_rolling4"]


def _paths(
    predict: Callable[[np.ndarray], np.ndarray], spreads: bool, horizon: int,
    last: np.ndarray, held: pa.Array, recent: pa.Array,
) -> tuple[np.ndarray, np.ndarray]:
    """Predictions by step of many series, and which of them are unknown.

    From the last dates, the held inputs and the newest sales first. Unknown sales count as 0 in lags and
    leave no mean; where ``spreads``, an unknown input makes the prediction unknown, otherwise it is a NaN.
    """
    at = {name: i for i, name in enumerate(INPUTS)}
    inputs = np.empty((len(INPUTS), len(last)))
    inputs[[at[name] for name in (*SERIES, *HELD)]] = by_input(held)
    lost = held.flatten().is_null().to_numpy(zero_copy_only=False).reshape(len(last), -1).any(axis=1)
    # Sales by place; those that a series does not have add nothing.
    size = recent.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    there = np.arange(_RECENT)[:, None] < size
    sales, unknown = np.zeros(there.shape), np.zeros(there.shape, bool)
    given = recent.flatten()
    sales.T[there.T] = given.to_numpy(zero_copy_only=False)
    unknown.T[there.T] = given.is_null().to_numpy(zero_copy_only=False)
    path, absent = np.empty((horizon, len(last))), np.zeros((horizon, len(last)), bool)
    for step in range(horizon):
        for name, value in _calendar_of(last + 7 * (step + 1)).items():
            inputs[at[name]] = value
        total = np.zeros(len(last))
        for each in sales:
            total = total + each
        for i in (1, 2, 3):
            inputs[at[f"{LABEL}_lag{i}"]] = np.where(unknown[i - 1], 0.0, sales[i - 1])
        inputs[at[f"{LABEL}_rolling4"]] = total / size
        path[step] = predict(inputs)
        if spreads:
            absent[step] = lost | unknown.any(axis=0)
        sales, unknown = np.roll(sales, 1, 0), np.roll(unknown, 1, 0)
        sales[0], unknown[0] = path[step], absent[step]
        size = np.minimum(size + 1, _RECENT)
    return path, absent


def _in_batches(
    state: DataFrame, horizon: int, predict: Callable[[np.ndarray], np.ndarray], spreads: bool
) -> DataFrame:
    """The whole horizon in one pass, the series of a batch a step at a time."""

    @F.arrow_udf("array<double>")
    def path(last: pa.Array, held: pa.Array, recent: pa.Array) -> pa.Array:
        if not len(last):
            return pa.array([], pa.list_(pa.float64()))
        days = last.to_numpy(zero_copy_only=False).astype("datetime64[D]")
        steps, absent = _paths(predict, spreads, horizon, days, held, recent)
        ends = pa.array(np.arange(len(last) + 1) * horizon, pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(steps.T.ravel(), mask=absent.T.ravel()))

    held = F.array(*[F.col(name).cast("double") for name in (*SERIES, *HELD)])
    return state.withColumn("path", path("last_date", held, "recent"))


def _linear_steps(model: LinearRegressionModel | LineModel, state: DataFrame, horizon: int) -> DataFrame:
    weight = dict(zip(INPUTS, (float(w) for w in model.coefficients)))
    intercept = float(model.intercept)

    def predicted(inputs: np.ndarray) -> np.ndarray:
        value = np.full(inputs.shape[1], intercept)
        for name in (*SERIES, *HELD, *_MOVING):
            value = value + inputs[INPUTS.index(name)] * weight[name]
        return value

    return _in_batches(state, horizon, predicted, spreads=True)


def _tree_steps(
    model: RandomForestRegressionModel | GBTRegressionModel | TreesModel, state: DataFrame, horizon: int
) -> DataFrame:
    return _in_batches(state, horizon, trees_of(model).predict, spreads=False)
