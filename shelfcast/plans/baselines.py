"""Closed-form forecasts per series, a trend fit, and back-test measures.

They take regular weekly series (``fill_weekly_gaps``), so positions count weeks. Each
forecast is one shuffle by series followed by aggregates on the same partitioning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.cleaning import SERIES, as_date
from shelfcast.operators.series import HOLDOUT_WEEKS, by_date, latest_first, mark_holdout

SEASON_WEEKS = 52


def recent_values(df: DataFrame, n: int, value: str = "weekly_sales", also: list[str] | None = None):
    """Last date and the newest ``n`` values of each series, newest first, in one array."""
    newest = df.withColumn("newest", F.row_number().over(latest_first())).filter(F.col("newest") <= n)
    ordered = F.array_sort(F.collect_list(F.struct("newest", F.col(value).alias("value"))))
    return newest.groupBy(*SERIES).agg(
        F.max("date").alias("last_date"),
        F.transform(ordered, lambda x: x["value"]).alias("recent"),
        *[F.max_by(c, "date").alias(c) for c in also or []],
    )


def _ahead(per_series: DataFrame, horizon: int, prediction: Column) -> DataFrame:
    """One row per future week; ``prediction`` may use the column ``step``."""
    return per_series.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).select(
        *SERIES,
        F.expr("date_add(last_date, 7 * step)").alias("date"),
        prediction.alias("predicted_weekly_sales"),
    )


def seasonal_naive(df: DataFrame, horizon: int = SEASON_WEEKS) -> DataFrame:
    """The value one season before; the last value where the series is shorter than that."""
    season = recent_values(df, SEASON_WEEKS)
    position = F.lit(SEASON_WEEKS - 1) - (F.col("step") - 1) % SEASON_WEEKS
    return _ahead(season, horizon, F.coalesce(F.get("recent", position), F.get("recent", F.lit(0))))


def drift(df: DataFrame, horizon: int = SEASON_WEEKS, value: str = "weekly_sales") -> DataFrame:
    """Straight line through the first and the last value."""
    ends = df.groupBy(*SERIES).agg(
        F.max("date").alias("last_date"),
        F.min_by(value, "date").alias("first_value"),
        F.max_by(value, "date").alias("last_value"),
        F.count(F.lit(1)).alias("n"),
    )
    rise = (F.col("last_value") - F.col("first_value")) / F.greatest(F.col("n") - 1, F.lit(1))
    return _ahead(ends, horizon, F.col("last_value") + rise * F.col("step"))


def ar1_on_differences(
    df: DataFrame, horizon: int = SEASON_WEEKS, value: str = "weekly_sales"
) -> DataFrame:
    """AR(1) on weekly differences, extrapolated in closed form.

    With differences d and d' = a + b d, the sum of the next h differences is
    h m + (d - m) b (1 - b^h) / (1 - b) around their mean m = a / (1 - b). Series too short
    for a fit repeat their last value.
    """
    one, two = F.lag(value, 1).over(by_date()), F.lag(value, 2).over(by_date())
    differences = df.select(
        *SERIES, "date", value, (F.col(value) - one).alias("now"), (one - two).alias("before")
    )
    fit = differences.groupBy(*SERIES).agg(
        F.max("date").alias("last_date"),
        F.max_by(value, "date").alias("last_value"),
        F.max_by("now", "date").alias("d"),
        F.regr_slope("now", "before").alias("b"),
        F.regr_intercept("now", "before").alias("a"),
    )
    return _ahead(fit, horizon, F.col("last_value") + summed_differences(F.col("step")))


def summed_differences(h: Column) -> Column:
    """Sum of the next ``h`` differences of the line ``a + b d``, 0 without a line."""
    a, b, d = F.col("a"), F.col("b"), F.col("d")
    mean = a / (1 - b)
    damped = h * mean + (d - mean) * b * (1 - F.pow(b, h)) / (1 - b)
    linear = h * d + a * h * (h + 1) / 2
    return F.coalesce(F.when(b == 1, linear).otherwise(damped), F.lit(0.0))


def trend_regression(df: DataFrame, origin: dt.date | str, value: str = "weekly_sales") -> DataFrame:
    """Least-squares line of sales over weeks since a fixed origin, for each series."""
    week = F.datediff(F.col("date"), as_date(origin)) / 7
    return df.withColumn("week_index", week).groupBy(*SERIES).agg(
        F.regr_slope(value, "week_index").alias("slope"),
        F.regr_intercept(value, "week_index").alias("intercept"),
        F.regr_r2(value, "week_index").alias("r2"),
    )


def accuracy_by_series(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """RMSE and MAPE; zero actuals do not count for MAPE, which is null if none is left."""
    error = F.col(actual) - F.col(predicted)
    share = F.when(F.col(actual) != 0, F.abs(error / F.col(actual)))
    return scored.groupBy(*SERIES).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(share).alias("mape")
    )


def backtest_seasonal_naive(
    df: DataFrame, weeks: int = HOLDOUT_WEEKS, value: str = "weekly_sales"
) -> DataFrame:
    """Seasonal naive on the last observed weeks of each regular series.

    Filled weeks carry the season forward but are never scored.
    """
    season_ago = F.lag(value, SEASON_WEEKS).over(by_date())
    observed = df.withColumn("predicted", season_ago).filter(F.col("is_filled") == 0)
    scored = mark_holdout(observed, weeks).filter(F.col("is_test") == 1)
    return accuracy_by_series(scored, value, "predicted")
