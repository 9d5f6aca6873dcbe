"""Forecast errors by horizon from many origins per series, in one pass.

A back-test from one split says how a method did once. Here every one of a series' last weeks
that still has a full horizon behind it is an origin. What a method knows at an origin are
statistics of the rows up to it, which windows accumulate, so no origin is fitted anew: one
shuffle by series serves the gap filling, all origins and the errors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.cleaning import SERIES
from shelfcast.operators.series import HOLDOUT_WEEKS, by_date, whole_series
from shelfcast.plans.baselines import SEASON_WEEKS, summed_differences

METHODS = ("naive", "seasonal_naive", "ar1")


def origins(
    df: DataFrame, count: int = HOLDOUT_WEEKS, horizon: int = HOLDOUT_WEEKS, value: str = "weekly_sales"
) -> DataFrame:
    """The last ``count`` weeks of each regular series that ``horizon`` weeks follow.

    Each has the last value, the last difference ``d``, the line ``a + b d`` fitted to the
    differences up to it, and the weeks ahead with the value one season before them.
    """
    if not 0 < horizon <= SEASON_WEEKS:
        raise ValueError(f"a horizon is 1 to {SEASON_WEEKS} weeks, as a season ago must be known")
    known = by_date().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    week = F.struct(F.col(value).alias("actual"), "season_ago", "is_filled")
    one, two = F.lag(value, 1).over(by_date()), F.lag(value, 2).over(by_date())
    rows = df.select(
        *SERIES,
        "date",
        value,
        "is_filled",
        F.lag(value, SEASON_WEEKS).over(by_date()).alias("season_ago"),
        (F.col(value) - one).alias("d"),
        (one - two).alias("before"),
        F.row_number().over(by_date()).alias("position"),
        F.count(F.lit(1)).over(whole_series()).alias("n"),
    )
    fitted = rows.withColumns(
        {
            "b": F.regr_slope("d", "before").over(known),
            "a": F.regr_intercept("d", "before").over(known),
            "ahead": F.collect_list(week).over(by_date().rowsBetween(1, horizon)),
        }
    )
    follow = F.col("n") - F.col("position")
    return fitted.filter(follow.between(horizon, horizon + count - 1)).select(
        *SERIES, F.col("date").alias("origin"), F.col(value).alias("last_value"), "d", "a", "b", "ahead"
    )


def errors_by_horizon(
    df: DataFrame, count: int = HOLDOUT_WEEKS, horizon: int = HOLDOUT_WEEKS, value: str = "weekly_sales"
) -> DataFrame:
    """Root mean squared and mean absolute error of each method, per series and weeks ahead.

    Takes regular series (``fill_weekly_gaps``). Filled weeks are never scored. ``seasonal_naive``
    falls back to the last value where the series is younger than a season.
    """
    weeks = origins(df, count, horizon, value).select(
        *SERIES, "last_value", "d", "a", "b", F.posexplode("ahead").alias("place", "week")
    )
    step, last = F.col("place") + 1, F.col("last_value")
    forecasts = {
        "naive": last,
        "seasonal_naive": F.coalesce("week.season_ago", last),
        "ar1": last + summed_differences(step),
    }
    errors = weeks.filter("week.is_filled = 0").select(
        *SERIES, step.alias("step"), *[(F.col("week.actual") - forecasts[m]).alias(m) for m in METHODS]
    )
    return errors.groupBy(*SERIES, "step").agg(
        F.count(F.lit(1)).alias("weeks"),
        *[F.sqrt(F.avg(F.col(m) * F.col(m))).alias(f"rmse_{m}") for m in METHODS],
        *[F.avg(F.abs(m)).alias(f"mae_{m}") for m in METHODS],
    )
