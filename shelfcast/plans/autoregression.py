"""Autoregressions per series with their order chosen, as aggregates and column expressions only.

Windows over regular weekly series give lagged products; one aggregate per series turns them into
autocovariances of the values and of their weekly differences. Levinson's recursion solves all orders
in a fold over the lags, a corrected AIC chooses the difference and the order, and another fold runs the
forecast. One shuffle by series, no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.cleaning import SERIES
from shelfcast.operators.series import by_date, whole_series
from shelfcast.plans.baselines import SEASON_WEEKS

MAX_ORDER = 2
_NO_WEIGHTS = "array<double>"


def _named(value: Column, use) -> Column:
    """Computes a value once for an expression that uses it several times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def autocovariances(regular: DataFrame, max_order: int = MAX_ORDER, value: str = "weekly_sales") -> DataFrame:
    """One row per series: mean, autocovariances and newest centred values, for 0 and 1 differences.

    The divisor is the number of values, which keeps every solution stable.
    """
    kept = regular.select(*SERIES, "date", F.col(value).cast("double").alias("y0"))
    df = kept.withColumn("y1", F.col("y0") - F.lag("y0").over(by_date()))
    lags = range(max_order + 1)
    for d in (0, 1):
        df = df.withColumn(f"m{d}", F.avg(f"y{d}").over(whole_series())).withColumn(
            f"z{d}_0", F.col(f"y{d}") - F.col(f"m{d}")
        )
    df = df.withColumns(
        {f"z{d}_{k}": F.lag(f"z{d}_0", k).over(by_date()) for d in (0, 1) for k in lags if k}
    )
    stated = []
    for d in (0, 1):
        n = F.greatest(F.count(f"y{d}"), F.lit(1))
        covariances = [F.coalesce(F.sum(F.col(f"z{d}_0") * F.col(f"z{d}_{k}")), F.lit(0.0)) / n for k in lags]
        newest = F.array(*(F.coalesce(f"z{d}_{k}", F.lit(0.0)) for k in range(max(max_order, 1))))
        stated += [
            F.max(f"m{d}").alias(f"mean{d}"),
            F.array(*covariances).alias(f"covariances{d}"),
            F.max_by(newest, "date").alias(f"recent{d}"),
        ]
    return df.groupBy(*SERIES).agg(
        F.count("y0").alias("points"), F.max("date").alias("last_date"),
        F.max_by("y0", "date").alias("last_value"), *stated,
    )


def _score(points: Column, left: Column, order: Column) -> Column:
    """Corrected AIC; a model that leaves nothing is best, one with too few points is none."""
    k = order + 1
    spare = points - k - 1
    fit = F.when(left > 0, points * F.log(left)).otherwise(F.lit(-1e300))
    return F.when(spare > 0, fit + 2 * k + 2 * k * (k + 1) / spare)


def _orders(covariances: Column, points: Column, differences: int, max_order: int) -> Column:
    """Models of all orders by Levinson's recursion: array of (score, differences, order, weights)."""

    def model(order: Column, left: Column, weights: Column) -> Column:
        return F.struct(
            _score(points, left, order).alias("score"), F.lit(differences).alias("differences"),
            order.alias("order"), weights.alias("weights"),
        )

    def longer(state: Column, k: Column) -> Column:
        past = F.reverse(F.slice(covariances, 2, k - 1))
        gap = F.get(covariances, k) - _total(F.zip_with(state["weights"], past, lambda a, b: a * b))
        reflection = F.when(state["left"] > 0, gap / state["left"]).otherwise(F.lit(0.0))

        def advanced(r: Column) -> Column:
            mirrored = F.zip_with(state["weights"], F.reverse(state["weights"]), lambda a, b: a - r * b)
            weights, left = F.concat(mirrored, F.array(r)), state["left"] * (1 - r * r)
            return F.struct(
                weights.alias("weights"), left.alias("left"),
                F.concat(state["models"], F.array(model(k, left, weights))).alias("models"),
            )

        return _named(reflection, advanced)

    none, left = F.array().cast(_NO_WEIGHTS), F.get(covariances, F.lit(0))
    start = F.struct(
        none.alias("weights"), left.alias("left"), F.array(model(F.lit(0), left, none)).alias("models")
    )
    lags = F.sequence(F.lit(1), F.lit(max_order)) if max_order else F.array().cast("array<int>")
    return F.aggregate(lags, start, longer, lambda s: s["models"])


def choose_orders(regular: DataFrame, max_order: int = MAX_ORDER, value: str = "weekly_sales") -> DataFrame:
    """Per series the model of lowest score: differences, order, weights, and where forecasts start.

    All models of a series are compared on as many points as the differences have. Equal scores go
    to fewer differences, then to the lower order; a series too short for any keeps its last value.
    """
    per_series = autocovariances(regular, max_order, value)
    points = F.col("points") - 1
    every = F.concat(*(_orders(F.col(f"covariances{d}"), points, d, max_order) for d in (0, 1)))
    best = F.array_min(F.filter(every, lambda m: m["score"].isNotNull()))
    # A generator's row is computed once; a plain column would be repeated wherever it is used.
    means = ["mean0", "mean1", "recent0", "recent1"]
    chosen = per_series.select(*SERIES, "last_date", "last_value", *means, F.inline_outer(F.array(best)))
    short = F.col("differences").isNull()
    differences = F.coalesce("differences", F.lit(1))
    return chosen.select(
        *SERIES, "last_date", "last_value",
        differences.alias("differences"),
        F.coalesce("order", F.lit(0)).alias("order"),
        F.coalesce("weights", F.array().cast(_NO_WEIGHTS)).alias("weights"),
        F.when(short, 0.0).when(differences == 0, F.col("mean0")).otherwise(F.col("mean1")).alias("mean"),
        F.when(differences == 0, F.col("recent0")).otherwise(F.col("recent1")).alias("recent"),
    )


def forecast_autoregression(
    regular: DataFrame, horizon: int = SEASON_WEEKS, max_order: int = MAX_ORDER, value: str = "weekly_sales"
) -> DataFrame:
    """Weekly forecasts from the week after each series' last date, with the model's order and differences."""

    def advance(state: Column, _: Column) -> Column:
        pulled = _total(F.zip_with(F.col("weights"), F.slice(state["recent"], 1, F.col("order")), lambda a, b: a * b))

        def moved(x: Column) -> Column:
            level = F.when(F.col("differences") == 1, state["level"]).otherwise(F.lit(0.0)) + F.col("mean") + x
            kept = F.slice(F.concat(F.array(x), state["recent"]), 1, max(max_order, 1))
            return F.struct(
                kept.alias("recent"), level.alias("level"), F.concat(state["path"], F.array(level)).alias("path")
            )

        return _named(pulled, moved)

    start = F.struct(
        F.col("recent"), F.col("last_value").alias("level"), F.array().cast("array<double>").alias("path")
    )
    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, advance, lambda s: s["path"])
    chosen = choose_orders(regular, max_order, value).withColumn("path", path)
    return chosen.select(*SERIES, "last_date", "differences", "order", F.posexplode_outer("path")).select(
        *SERIES, F.expr("date_add(last_date, 7 * (pos + 1))").alias("date"), "differences", "order",
        F.col("col").alias("predicted_weekly_sales"),
    )
