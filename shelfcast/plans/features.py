"""The combined feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import calendar, holiday_flag, total_of
from shelfcast.operators.cleaning import (
    SALES_KEY,
    fill_by_type,
    highest_sale_per_key,
    keep_complete,
    one_row_per_key,
)
from shelfcast.operators.scaling import standardize
from shelfcast.operators.series import model_lags
from shelfcast.sources.schemas import MARKDOWNS

ECONOMY = ["cpi", "unemployment", "fuel_price"]


def total_markdown(df: DataFrame) -> DataFrame:
    """Sum of the markdown columns that exist."""
    return df.withColumn("total_markdown", total_of([c for c in MARKDOWNS if c in df.columns]))


def with_conditions(sales: DataFrame, features: DataFrame) -> DataFrame:
    """Sales with the features of their store and week, both dates already parsed."""
    return sales.join(features, ["store", "date"], "left")


def enrich_sales(sales: DataFrame, features: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales with the features of their store and week and the attributes of their store.

    No side is hinted: Spark broadcasts one only where file sizes, or the sizes seen at run
    time, allow it, and otherwise splits skewed partitions of the sales.
    """
    return with_conditions(sales, features).join(stores, "store", "left")


def retail_features(sales: DataFrame, features: DataFrame, stores: DataFrame) -> DataFrame:
    """Feature table, one row per store, department and date.

    The order matters: lags before scaling before filling, so a first week has lag 0 and a
    missing indicator takes the scaled value 0. Sales themselves stay null where missing, and
    the row keeps its place in the lags. Repeated features of a store and date count once.
    """
    flagged = sales.withColumn("isholidayencoded", holiday_flag("isholiday"))
    known = keep_complete(flagged, SALES_KEY)
    lagged = model_lags(highest_sale_per_key(known, "isholidayencoded"))
    conditions = one_row_per_key(features, ["store", "date"])
    return filled(with_store(standardize(with_conditions(lagged, conditions), ECONOMY), stores))


def with_store(rows: DataFrame, stores: DataFrame) -> DataFrame:
    """Attributes of the store, markdown total, holiday text and calendar fields."""
    fields = calendar("date")
    return total_markdown(rows.join(stores, "store", "left")).withColumns(
        {
            "isholiday": F.when(F.col("isholidayencoded") == 1, "TRUE").otherwise("FALSE"),
            **{name: fields[name] for name in ("week", "month", "year")},
        }
    )


def filled(rows: DataFrame) -> DataFrame:
    """Missing values by type; sales stay missing."""
    return fill_by_type(rows, keep=(*SALES_KEY, "weekly_sales"))


def scaled_economy(sales: DataFrame, features: DataFrame) -> DataFrame:
    joined = with_conditions(
        sales.select("store", "dept", "date"), features.select("store", "date", *ECONOMY)
    )
    return standardize(joined, ECONOMY).select(
        "store", "dept", "date", *[F.col(f"{c}_scaled") for c in ECONOMY]
    )
