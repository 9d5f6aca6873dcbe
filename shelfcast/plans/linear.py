"""The linear model over the feature table: fitted, applied and cross-validated from merged sums."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import least_squares
from shelfcast.operators.cleaning import SERIES, as_date, before
from shelfcast.plans.models import CONDITIONS, INPUTS, LABEL, model_inputs, test_rows

_SCORES = "fold int, cut date, rows bigint, rmse double, r2 double"


def fit(features: DataFrame, cut: dt.date | str) -> least_squares.Line:
    """Least squares on the rows before the cut, missing conditions filled with their mean there."""
    train = model_inputs(before(features, cut))
    given = least_squares.layout(train, INPUTS, CONDITIONS, LABEL)
    parts = least_squares.products(train, given, F.lit(0))
    size = len(given.terms())
    return least_squares.solve(given, parts.get(0, np.zeros((size, size))))


def predict(features: DataFrame, cut: dt.date | str) -> DataFrame:
    """Rows from the cut on with the prediction of the line fitted before it."""
    line = fit(features, cut)
    return test_rows(features, cut).select(
        *SERIES, "date", LABEL, line.prediction().alias("predicted_weekly_sales")
    )


def cross_validate(
    features: DataFrame, first_cut: dt.date, folds: int = 3, weeks: int = 13
) -> DataFrame:
    """Folds in time order: train before a cut, score the weeks after it, move the cut on.

    One scan, however many folds: rows are summed by the stretch between cuts that they lie in, a
    fold trains on the stretches before its cut and is scored on the sums of the one after it.
    """
    cuts = [first_cut + dt.timedelta(weeks=weeks * fold) for fold in range(folds)]
    rows = model_inputs(before(features, cuts[-1] + dt.timedelta(weeks=weeks)))
    given = least_squares.layout(rows, INPUTS, CONDITIONS, LABEL)
    stretch = sum((F.when(F.col("date") >= as_date(c), 1).otherwise(0) for c in cuts), F.lit(0))
    parts = least_squares.products(rows, given, stretch)
    size = len(given.terms())
    none = np.zeros((size, size))
    scores, train = [], none
    for fold, cut in enumerate(cuts):
        train = train + parts.get(fold, none)
        line = least_squares.solve(given, train)
        scores.append((fold + 1, cut, *least_squares.errors(line, parts.get(fold + 1, none))))
    return features.sparkSession.createDataFrame(scores, _SCORES)
