"""Report tables over the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import exact_sum, fine_sum, percent_change


def actual_vs_predicted_trend(fact: DataFrame) -> DataFrame:
    return fact.groupBy("date").agg(
        exact_sum("actual_weekly_sales").alias("actual_sales"),
        fine_sum("predicted_weekly_sales").alias("predicted_sales"),
    )


def performance(fact: DataFrame, by: str) -> DataFrame:
    """Totals and error by store or by department."""
    return fact.groupBy(by).agg(
        F.count(F.lit(1)).alias("weeks"),
        exact_sum("actual_weekly_sales").alias("actual_sales"),
        fine_sum("predicted_weekly_sales").alias("predicted_sales"),
        F.avg(F.abs("prediction_error_percentage")).alias("avg_absolute_error_percentage"),
    )


def sales_cards(fact: DataFrame) -> DataFrame:
    total = exact_sum("actual_weekly_sales")
    return fact.agg(
        total.alias("total_sales"),
        (total / F.nullif(F.count("actual_weekly_sales"), F.lit(0))).alias("average_sales"),
    )


def monthly_pct_change(trend: DataFrame) -> DataFrame:
    """Change against the month before.

    The window has no partition key, but the monthly table it runs on has one row per month
    of the calendar.
    """
    previous = F.lag("total_sales").over(Window.orderBy("year", "month"))
    return trend.select("year", "month", "total_sales", previous.alias("previous_sales")).withColumn(
        "pct_change", percent_change(F.col("total_sales"), F.col("previous_sales"))
    )


def top_departments(fact: DataFrame, k: int = 3) -> DataFrame:
    """The k best-selling departments of each store; ties share a rank."""
    totals = fact.groupBy("store", "dept").agg(exact_sum("actual_weekly_sales").alias("total_sales"))
    place = F.rank().over(Window.partitionBy("store").orderBy(F.col("total_sales").desc()))
    return totals.withColumn("place", place).filter(F.col("place") <= k)
