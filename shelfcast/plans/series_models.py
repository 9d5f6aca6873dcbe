"""A statistical model for every series, fitted in parallel by Spark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

import shelfcast
from shelfcast.operators.arma import forecast
from shelfcast.operators.cleaning import SERIES, trailing_months
from shelfcast.operators.series import (
    HOLDOUT_MIN_POINTS,
    HOLDOUT_WEEKS,
    MAX_ZERO_SHARE,
    MIN_POINTS,
    fill_weekly_gaps,
    spread,
)
from shelfcast.plans.baselines import accuracy_by_series

# Python workers get this package's functions with the task, so it need not be installed there.
cloudpickle.register_pickle_by_value(shelfcast)

_VALUES = pa.list_(pa.float64())


def _usable(y: np.ndarray) -> bool:
    return len(y) >= MIN_POINTS and (y == 0).sum() <= MAX_ZERO_SHARE * len(y)


def _weeks_until(last: dt.date, origin: dt.date | None) -> int:
    """Weeks between the week after ``last`` and the first Friday from the origin on."""
    if origin is None:
        return 0
    return max(0, -(-(origin - last).days // 7) - 1)


def _each_series(
    weekly: DataFrame, values: list[str], fit: Callable[..., tuple | None], result: dict[str, pa.DataType]
) -> DataFrame:
    """A row per series with what ``fit`` makes of its dates and values in date order, none where that is none.

    Series reach Python as arrays, many of them in a batch: handing over a group for each takes
    several times as long as its model. The rows of a series are in one partition already.
    """
    columns = ["date", *values]
    typed = [F.col("date"), *[F.col(v).cast("double").alias(v) for v in values]]
    weeks = weekly.groupBy(*SERIES).agg(F.array_sort(F.collect_list(F.struct(*typed))).alias("weeks"))
    arrays = weeks.select(
        *[F.col(c).cast("int").alias(c) for c in SERIES], *[F.col("weeks")[c].alias(c) for c in columns]
    )
    made = pa.schema([*((c, pa.int32()) for c in SERIES), *result.items()])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c) for c in columns))
            found = [fit(*(x.values.to_numpy(zero_copy_only=False) for x in row)) for row in rows]
            kept = [i for i, f in enumerate(found) if f is not None]
            keys = [batch.column(c).take(pa.array(kept, pa.int32())) for c in SERIES]
            parts = [
                pa.array([found[i][k] for i in kept], kind) for k, kind in enumerate(result.values())
            ]
            yield pa.RecordBatch.from_arrays([*keys, *parts], schema=made)

    return arrays.mapInArrow(fitted, from_arrow_schema(made))


def forecast_by_series(
    sales: DataFrame,
    horizon: int = 122,
    cut: dt.date | str | None = None,
    months: int = 24,
    origin: dt.date | None = None,
) -> DataFrame:
    """Weekly forecasts from the week after the last date of each usable series.

    With an ``origin`` every series forecasts the Fridays from that date on, as many weeks ahead
    of its own end as that takes. A series that ends later starts after its end.

    Series that are too short or mostly zero give no rows. Sales hold one row per series
    and date, so a group is at most the weeks of the calendar; the window that fills the
    gaps and the grouping share one shuffle.
    """
    weekly = fill_weekly_gaps(spread(sales, *SERIES))
    if cut is not None:
        weekly = trailing_months(weekly, cut, months)

    def one(dates: np.ndarray, y: np.ndarray) -> tuple | None:
        if not _usable(y):
            return None
        last = dates[-1].item()
        skipped = _weeks_until(last, origin)
        return last + dt.timedelta(weeks=skipped), forecast(y, skipped + horizon)[skipped:]

    ahead = _each_series(weekly, ["weekly_sales"], one, {"last_date": pa.date32(), "path": _VALUES})
    return ahead.select(*SERIES, "last_date", F.posexplode("path")).select(
        *SERIES,
        F.expr("date_add(last_date, 7 * (pos + 1))").alias("date"),
        F.col("col").alias("predicted_weekly_sales"),
    )


def backtest_by_series(
    sales: DataFrame, weeks: int = HOLDOUT_WEEKS, method: Callable[..., np.ndarray] = forecast
) -> DataFrame:
    """RMSE and MAPE per series of a method fitted without the last observed weeks.

    ``method(values, horizon)`` gives the forecast; filled weeks are forecast but not scored.
    """

    def one(dates: np.ndarray, y: np.ndarray, is_filled: np.ndarray) -> tuple | None:
        observed = np.flatnonzero(is_filled == 0)
        if len(observed) <= HOLDOUT_MIN_POINTS:
            return None
        first = observed[-weeks]
        predicted = method(y[:first], len(y) - first)
        scored = observed[-weeks:]
        return y[scored], np.asarray(predicted, dtype=float)[scored - first]

    weekly = fill_weekly_gaps(spread(sales, *SERIES))
    result = {"actual": _VALUES, "predicted": _VALUES}
    scored = _each_series(weekly, ["weekly_sales", "is_filled"], one, result).select(
        *SERIES, F.inline(F.arrays_zip("actual", "predicted"))
    )
    return accuracy_by_series(scored, "actual", "predicted").select(
        *SERIES, F.col("rmse"), F.col("mape")
    )
