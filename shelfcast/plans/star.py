"""Staging models, dimensions, the sales fact and its KPI tables.

``literal`` variants reproduce a defect of the documented models on purpose: features are
not reduced to one row per store and date, so every sale counts once per features row.
They carry that number as ``copies`` instead of writing the copies out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import (
    calendar,
    exact_sum,
    holiday_flag,
    per_unit,
    percent_change,
)
from shelfcast.operators.cleaning import (
    SALES_KEY,
    highest_sale_per_key,
    keep_complete,
    one_row_per_key,
)

CONDITIONS = ["temperature", "fuel_price", "cpi", "unemployment"]

# Upper bounds in percent of the accuracy bands.
EXCELLENT, GOOD, FAIR = 5, 10, 20


def stg_sales(sales: DataFrame) -> DataFrame:
    """Complete rows, one per store, department and date, with a 0/1 holiday flag."""
    typed = sales.select(
        F.col("store").cast("int").alias("store"),
        F.col("dept").cast("int").alias("dept"),
        F.col("date").cast("date").alias("date"),
        F.col("weekly_sales").cast("double").alias("weekly_sales"),
        holiday_flag("isholiday").alias("isholiday"),
    )
    return highest_sale_per_key(keep_complete(typed, [*SALES_KEY, "weekly_sales"]))


def stg_stores(stores: DataFrame) -> DataFrame:
    typed = stores.select(
        F.col("store").cast("int").alias("store"), "type", F.col("size").cast("int").alias("size")
    )
    return keep_complete(typed, ["store"])


def _typed_features(features: DataFrame) -> DataFrame:
    typed = features.select(
        F.col("store").cast("int").alias("store"),
        F.col("date").cast("date").alias("date"),
        *[F.col(c).cast("double").alias(c) for c in CONDITIONS],
    )
    return keep_complete(typed, ["store", "date"])


def stg_features(features: DataFrame) -> DataFrame:
    """One row per store and date; of rows that differ, one stays as it is."""
    return one_row_per_key(_typed_features(features), ["store", "date"])


def stg_features_literal(features: DataFrame) -> DataFrame:
    """Distinct rows with the number of times each occurs."""
    return _typed_features(features).groupBy("store", "date", *CONDITIONS).agg(
        F.count(F.lit(1)).alias("copies")
    )


def dim_store(stores: DataFrame) -> DataFrame:
    return stores.select(
        F.col("store").alias("store_id"),
        F.col("type").alias("store_type"),
        F.col("size").alias("store_size"),
    )


def dim_date(dates: DataFrame) -> DataFrame:
    fields = calendar("date")
    return dates.select("date").distinct().select(
        "date",
        fields["day_of_week"].alias("day_of_week"),
        fields["week"].alias("week_number"),
        fields["month"].alias("month"),
        fields["quarter"].alias("quarter"),
        fields["year"].alias("year"),
        fields["is_weekend"].alias("is_weekend"),
    )


def fct_sales_analytics(
    sales: DataFrame,
    features: DataFrame,
    stores: DataFrame,
    predictions: DataFrame,
    literal: bool = False,
) -> DataFrame:
    """Sales with predictions, conditions, store attributes and error measures.

    Takes the staging tables. Predictions join first, on the key the deduplicated sales are
    already partitioned by. With ``literal`` the features carry ``copies``, the fact keeps
    them, and the holiday flag is 0 because it compares an encoded flag with text.
    """
    joined = (
        sales.join(predictions, SALES_KEY, "left")
        .join(features, ["store", "date"], "left")
        .join(stores, "store", "left")
    )
    actual, predicted, size = F.col("weekly_sales"), F.col("predicted_weekly_sales"), F.col("size")
    fields = calendar("date")
    flag = holiday_flag("isholiday", ("TRUE",)) if literal else F.col("isholiday")
    return joined.select(
        *SALES_KEY,
        actual.alias("actual_weekly_sales"),
        F.coalesce(predicted, F.lit(0.0)).alias("predicted_weekly_sales"),
        "isholiday",
        *CONDITIONS,
        F.col("type").alias("store_type"),
        size.alias("store_size"),
        per_unit(actual, size).alias("actual_sales_per_sqft"),
        per_unit(predicted, size).alias("predicted_sales_per_sqft"),
        percent_change(predicted, actual).alias("prediction_error_percentage"),
        (predicted - actual).alias("prediction_error_absolute"),
        fields["year"].alias("year"),
        fields["month"].alias("month"),
        fields["day_of_week"].alias("day_of_week"),
        flag.alias("is_holiday_flag"),
        *([F.coalesce("copies", F.lit(1)).alias("copies")] if literal else []),
    )


def fct_actual(fact: DataFrame) -> DataFrame:
    return fact.select(*SALES_KEY, "actual_weekly_sales")


def fct_predicted(fact: DataFrame) -> DataFrame:
    """Rows that have a prediction; a missing one shows as 0 in the combined fact only."""
    return fact.filter(F.col("prediction_error_absolute").isNotNull()).select(
        *SALES_KEY, "predicted_weekly_sales"
    )


def _sales_total(literal: bool) -> Column:
    return exact_sum("actual_weekly_sales", F.col("copies") if literal else 1)


def kpi_total_sales_by_store(fact: DataFrame, literal: bool = False) -> DataFrame:
    return fact.groupBy("store").agg(_sales_total(literal).alias("total_sales"))


def kpi_monthly_sales_trend(fact: DataFrame, literal: bool = False) -> DataFrame:
    return (
        fact.groupBy("year", "month")
        .agg(_sales_total(literal).alias("total_sales"))
        .orderBy("year", "month")
    )


_MONTH_KEY = ["store", "dept", "year", "month"]


def kpi_prediction_accuracy(fact: DataFrame, literal: bool = False) -> DataFrame:
    """Error statistics and band counts by series and month.

    The first three bands contain each other; only the last is disjoint from them.
    """
    error = F.col("prediction_error_percentage")
    known = fact.filter(error.isNotNull())
    if not literal:
        known = known.withColumn("copies", F.lit(1))
        spread = F.stddev_samp(error)
    else:
        # A month bounds the window: at most 31 dates of one series.
        month = Window.partitionBy(*_MONTH_KEY)
        mean = F.sum(error * F.col("copies")).over(month) / F.sum("copies").over(month)
        known = known.withColumn("squares", F.col("copies") * F.pow(error - mean, 2))
        weight = F.sum("copies")
        spread = F.when(weight > 1, F.sqrt(F.sum("squares") / (weight - 1)))

    copies = F.col("copies")

    def weighted_mean(value: Column) -> Column:
        return F.sum(value * copies) / F.sum(copies) if literal else F.avg(value)

    def band(condition: Column) -> Column:
        return F.sum(F.when(condition, copies).otherwise(0)).cast("bigint")

    return known.groupBy(*_MONTH_KEY).agg(
        F.sum(copies).cast("bigint").alias("total_predictions"),
        weighted_mean(F.abs(error)).alias("avg_absolute_error_percentage"),
        weighted_mean(error).alias("avg_error_percentage"),
        spread.alias("stddev_error_percentage"),
        band(F.abs(error) <= EXCELLENT).alias("excellent_predictions"),
        band(F.abs(error) <= GOOD).alias("good_predictions"),
        band(F.abs(error) <= FAIR).alias("fair_predictions"),
        band(F.abs(error) > FAIR).alias("poor_predictions"),
    )
