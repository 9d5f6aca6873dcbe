"""Duplicates, missing values and date cuts."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SERIES = ["store", "dept"]
SALES_KEY = ["store", "dept", "date"]

_NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def _is_numeric(dtype: str) -> bool:
    return dtype in _NUMERIC or dtype.startswith("decimal")


def highest_sale_per_key(sales: DataFrame, flag: str = "isholiday") -> DataFrame:
    """One row per store, department and date: the one with the highest sales.

    Equal sales keep the set 0/1 flag; so do rows of a key without any sales, which stays null.
    Written as hash aggregates, which combine copies of a key before the shuffle, where a ranking
    window would gather them in one task.
    """
    top, top_flagged = F.max("weekly_sales"), F.max(F.when(F.col(flag) == 1, F.col("weekly_sales")))
    unsold = F.col("weekly_sales").isNull() & (F.col("any_flag") == 1)
    return (
        sales.groupBy(*SALES_KEY)
        .agg(top.alias("weekly_sales"), top_flagged.alias("flagged"), F.max(flag).alias("any_flag"))
        .select(
            *SALES_KEY,
            "weekly_sales",
            F.when((F.col("flagged") == F.col("weekly_sales")) | unsold, 1).otherwise(0).alias(flag),
        )
    )


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One of the rows of each key as it is: the highest by its other columns, in their order."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max(F.struct(*others)).alias("row")).select(*keys, "row.*")


def keep_complete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without nulls in the columns; plain conditions, which reach the scan."""
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def fill_by_type(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nulls become ``Unknown`` in text and 0 in numbers, except in the columns to keep."""
    fills = {}
    for name, dtype in df.dtypes:
        if name in keep:
            continue
        if dtype == "string":
            fills[name] = "Unknown"
        elif _is_numeric(dtype):
            fills[name] = 0
    return df.fillna(fills)


def impute(
    df: DataFrame,
    zero: list[str],
    mean: list[str],
    training: DataFrame | None = None,
) -> DataFrame:
    """Nulls become 0 in some columns and the mean of the training rows in others.

    The means are one scalar subquery: one pass, no join, no driver step. It is a column of
    its own until used, so its plan occurs once however many columns it fills.
    """
    means = (df if training is None else training).agg(*[F.avg(c).alias(c) for c in mean])
    filled = {c: F.coalesce(F.col(c), F.col("training_means")[c]) for c in mean}
    filled.update({c: F.coalesce(F.col(c), F.lit(0.0)) for c in zero})
    return (
        df.withColumn("training_means", means.select(F.struct(*mean)).scalar())
        .withColumns(filled)
        .drop("training_means")
    )


def as_date(day: dt.date | str | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def before(df: DataFrame, day: dt.date | str) -> DataFrame:
    """Earlier rows. Stored tables are pruned where they are read (``tables.read_table``)."""
    return df.filter(F.col("date") < as_date(day))


def between_days(df: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Closed date range."""
    return df.filter(F.col("date").between(as_date(first), as_date(last)))


def trailing_months(df: DataFrame, cut: dt.date | str, months: int = 24) -> DataFrame:
    """Rows from ``months`` before the cut on."""
    return df.filter(F.col("date") >= F.add_months(as_date(cut), -months))


def hash_split(df: DataFrame, keys: list[str], train_percent: int, seed: int) -> DataFrame:
    """Mark each row train or test by a hash of its key.

    Unlike a random split the mark depends on the key only: not on the partitioning, on
    retried tasks or on the other rows.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("split", F.when(bucket < train_percent, "train").otherwise("test"))
