"""Weekly series per store and department.

These operators take one row per store, department and date (``highest_sale_per_key``),
so the calendar bounds every series whatever the number of raw rows behind it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfcast.functions.columns import calendar, is_friday
from shelfcast.operators.cleaning import SERIES, as_date, trailing_months

# Shortest usable series, largest share of zero weeks, back-test length.
MIN_POINTS = 30
MAX_ZERO_SHARE = 0.5
HOLDOUT_WEEKS = 13
HOLDOUT_MIN_POINTS = 20


def whole_series() -> WindowSpec:
    return Window.partitionBy(*SERIES)


def by_date() -> WindowSpec:
    return whole_series().orderBy("date")


def all_by_date() -> WindowSpec:
    """The whole series from every row of it; shares the sort of ``by_date``."""
    return by_date().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def latest_first() -> WindowSpec:
    return whole_series().orderBy(F.col("date").desc())


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows, or groups of the keys, over all cores.

    For work whose cost lies in computing rather than in bytes: Spark would merge its small
    shuffle partitions into few tasks, but keeps a stated number of them. Windows and groups
    by the keys that follow reuse the shuffle.
    """
    spark = df.sparkSession
    tasks = max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    return df.repartition(tasks, *keys)


def sales_lags(df: DataFrame, value: str = "weekly_sales", lags: int = 3) -> DataFrame:
    return df.withColumns(
        {f"{value}_lag{i}": F.lag(value, i).over(by_date()) for i in range(1, lags + 1)}
    )


def rolling_mean(value: str = "weekly_sales", first: int = -3, last: int = 0) -> Column:
    """Mean over a frame of rows of the series, by default the last four with the current."""
    return F.avg(value).over(by_date().rowsBetween(first, last))


def model_lags(df: DataFrame, value: str = "weekly_sales") -> DataFrame:
    """Lags 1-3 and the mean of the four weeks before: nothing of the week itself."""
    lagged = {f"{value}_lag{i}": F.lag(value, i).over(by_date()) for i in (1, 2, 3)}
    return df.withColumns({**lagged, f"{value}_rolling4": rolling_mean(value, -4, -1)})


def distinct_series(df: DataFrame) -> DataFrame:
    return df.select(*SERIES).distinct()


def weekly_dates(first: dt.date | str | Column, last: dt.date | str | Column) -> Column:
    """Every seventh day from the first to the last."""
    return F.sequence(as_date(first), as_date(last), F.expr("interval 7 days"))


def future_grid(df: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Every series with every future week."""
    return distinct_series(df).withColumn("date", F.explode(weekly_dates(first, last)))


def last_known(df: DataFrame, columns: list[str]) -> DataFrame:
    """The latest row of each series."""
    return df.groupBy(*SERIES).agg(
        F.max("date").alias("last_date"),
        *[F.max_by(c, "date").alias(c) for c in columns],
    )


def future_frame(
    train: DataFrame, columns: list[str], first: dt.date | str, last: dt.date | str
) -> DataFrame:
    """Future weeks of each series with its last known values and calendar fields.

    Grid and last values share their series, so one aggregate feeds both and no join is
    needed.
    """
    fields = calendar("date")
    return (
        last_known(train, columns)
        .withColumn("date", F.explode(weekly_dates(first, last)))
        .select(
            *SERIES, "date", *columns,
            *[fields[name].alias(name) for name in ("week", "month", "year")],
        )
    )


def fill_weekly_gaps(df: DataFrame, value: str = "weekly_sales") -> DataFrame:
    """Regular Friday series from the first to the last date; gaps repeat the value before.

    Each observed week is expanded up to the week before the next one, so a single window and sort
    replace the join with a date spine. Dates off the Friday grid drop out; missing values
    count as gaps.
    """
    observed = F.col(value).isNotNull() & is_friday("date")
    last_friday = F.date_sub(F.next_day(F.max("date").over(all_by_date()), "Fri"), 7)
    spans = (
        df.select(*SERIES, "date", value, last_friday.alias("series_end"))
        .filter(observed)
        .withColumn("next_date", F.lead("date").over(by_date()))
    )
    span_end = F.coalesce(F.date_sub("next_date", 7), "series_end")
    return spans.select(
        *SERIES,
        F.explode(weekly_dates(F.col("date"), span_end)).alias("week_date"),
        value,
        F.col("date").alias("observed_date"),
    ).select(
        *SERIES,
        F.col("week_date").alias("date"),
        value,
        F.when(F.col("week_date") == F.col("observed_date"), 0).otherwise(1).alias("is_filled"),
    )


def off_grid_rows(df: DataFrame) -> DataFrame:
    """Number of rows per series that the Friday grid drops."""
    return df.groupBy(*SERIES).agg(F.count_if(~is_friday("date")).alias("off_grid_rows"))


def forecastable_series(
    df: DataFrame,
    cut: dt.date | str | None = None,
    months: int = 24,
    value: str = "weekly_sales",
) -> DataFrame:
    """Series with enough points and not mostly zeros, optionally since ``months`` before a cut."""
    recent = df if cut is None else trailing_months(df, cut, months)
    return (
        recent.groupBy(*SERIES)
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.count_if(F.col(value) == 0).alias("zeros"),
        )
        .filter((F.col("points") >= MIN_POINTS) & (F.col("zeros") <= MAX_ZERO_SHARE * F.col("points")))
    )


def mark_holdout(df: DataFrame, weeks: int = HOLDOUT_WEEKS) -> DataFrame:
    """Mark the last weeks of each long enough series as test rows.

    Counted from the oldest week, so that a sort by date in front of it serves.
    """
    points = F.count(F.lit(1)).over(all_by_date())
    later = points - F.row_number().over(by_date())
    held = (later < weeks) & (points > HOLDOUT_MIN_POINTS)
    return df.withColumns({"points": points, "is_test": F.when(held, 1).otherwise(0)})
