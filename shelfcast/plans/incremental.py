"""The feature table week by week: a run reads its new sales and short tails, no history.

Three tables grow by runs, each run a partition of every one, named by its last date:

* ``feature_rows``: features of the run's sales, all but the scaled columns;
* ``series_tails``: the last four rows of every series, which the next run's lags need;
* ``feature_moments``: count, mean and squared deviations of the run's indicators.

Scaled columns depend on all rows, so they are computed on reading, from moments merged over the
runs. A repeated run replaces its own partitions and starts from the tails of the run before it,
so a run that broke off half way is simply run again; later runs, if any, are to be repeated in
order. Sales dated before the run's first or after its last date are kept aside in ``off_run_sales``
and take no part.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import holiday_flag
from shelfcast.operators.cleaning import (
    SALES_KEY,
    as_date,
    highest_sale_per_key,
    keep_complete,
    one_row_per_key,
)
from shelfcast.operators.scaling import merged_moments, moments, standardize_by
from shelfcast.operators.series import latest_first, model_lags
from shelfcast.plans.features import ECONOMY, filled, with_conditions, with_store
from shelfcast.plans.jobs import STAGING, Layers

#: Earlier rows that lags and the rolling mean of a week reach back to.
REACH = 4
ROWS, TAILS, MOMENTS, ASIDE = "feature_rows", "series_tails", "feature_moments", "off_run_sales"
_TAIL = [*SALES_KEY, "weekly_sales", "isholidayencoded"]


def cut_to_run(sales: DataFrame, after: dt.date | None, last: dt.date) -> tuple[DataFrame, DataFrame]:
    """Sales with ``after < date <= last``, and the others; rows without a whole key are in neither."""
    known = keep_complete(sales, SALES_KEY)
    inside = F.col("date") <= as_date(last)
    if after is not None:
        inside = inside & (F.col("date") > as_date(after))
    return known.filter(inside), known.filter(~inside)


def with_tails(sales: DataFrame, tails: DataFrame | None) -> DataFrame:
    """One row per key of the new sales, and before them the tails; ``is_new`` tells them apart."""
    flagged = sales.withColumn("isholidayencoded", holiday_flag("isholiday"))
    new = highest_sale_per_key(flagged, "isholidayencoded").select(*_TAIL, F.lit(True).alias("is_new"))
    if tails is None:
        return new
    return tails.select(*_TAIL, F.lit(False).alias("is_new")).unionByName(new)


def next_tails(rows: DataFrame) -> DataFrame:
    """The last ``REACH`` rows of every series, also of those without new sales."""
    back = F.row_number().over(latest_first())
    return rows.withColumn("back", back).filter(F.col("back") <= REACH).select(*_TAIL)


def new_features(rows: DataFrame, features: DataFrame, stores: DataFrame) -> DataFrame:
    """Features of the new rows; the tails only serve their lags."""
    lagged = model_lags(rows).filter("is_new").drop("is_new")
    return with_store(with_conditions(lagged, one_row_per_key(features, ["store", "date"])), stores)


def _named(run: dt.date) -> Column:
    return F.col("run").cast("string") == F.lit(run.isoformat())


def _run_before(layers: Layers, last: dt.date) -> dt.date | None:
    """The latest finished run before the given one; a run's moments are its last write."""
    if not layers.exists(STAGING, MOMENTS):
        return None
    run = F.col("run").cast("string")
    earlier = layers.read(STAGING, MOMENTS).filter(run < F.lit(last.isoformat()))
    name = earlier.agg(F.max(run).alias("run")).first()["run"]
    return None if name is None else dt.date.fromisoformat(name)


def extend(layers: Layers, sales: DataFrame, features: DataFrame, stores: DataFrame, last: dt.date) -> DataFrame:
    """Adds the sales up to ``last`` that follow the run before; returns the run's feature rows.

    Reads the given sales and the tails of one run: the work grows with the new rows and the number
    of series, not with the weeks stored. A run without sales only carries the tails on.
    """
    run, after = last.isoformat(), _run_before(layers, last)
    inside, aside = cut_to_run(sales, after, last)
    layers.write(aside, STAGING, ASIDE, run=run)
    rows = with_tails(inside, None)
    if after is not None:
        rows = with_tails(inside, layers.read_runs(STAGING, TAILS, rows.select(*_TAIL).schema).filter(_named(after)))
    added = layers.write(new_features(rows, features, stores), STAGING, ROWS, run=run).filter(_named(last))
    layers.write(next_tails(rows), STAGING, TAILS, run=run)
    layers.write(moments(added, ECONOMY), STAGING, MOMENTS, run=run)
    return added.drop("run")


def feature_table(layers: Layers) -> DataFrame:
    """All runs as one feature table, scaled by the moments of all of them."""
    rows = layers.read(STAGING, ROWS).drop("run")
    return filled(standardize_by(rows, merged_moments(layers.read(STAGING, MOMENTS)), ECONOMY))


__all__ = ["cut_to_run", "extend", "feature_table", "new_features", "next_tails", "with_tails"]
