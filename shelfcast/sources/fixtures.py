"""Retail inputs derived from the order tables.

A supplier stands for a store and a part's key modulo ``n_depts`` for a department, so the
number of series grows with the data while each series keeps about the same length.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.columns import MONEY, exact_sum, week_friday
from shelfcast.operators.cleaning import keep_complete
from shelfcast.sources.schemas import MARKDOWNS

# Fixed values of the derived inputs.
CUSTOMERS_PER_STORE = 15
HOLIDAY_WEEKS = (6, 36, 47, 52)
STORE_SIZE_STEP = 40_000


def _store_of_supplier(key: str) -> Column:
    return (F.col(key) + 1).cast("int").alias("store")


class RetailInputs:
    """The raw tables of one data folder, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str, n_depts: int = 4):
        self.spark = spark
        self.folder = folder
        self.n_depts = n_depts

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sales_base(
        self, first: dt.date | None = None, before: dt.date | None = None
    ) -> DataFrame:
        """One row per store, department and week, optionally of some weeks only.

        Null keys drop out at the scan, on every path alike, so that queries that use the
        sales twice share one scan and shuffle. Bounds on the week also bound the ship date,
        which lets Parquet skip row groups.
        """
        lines = keep_complete(self._read("lineitem"), ["l_suppkey", "l_partkey", "l_shipdate"])
        shipped, week = F.col("l_shipdate"), week_friday("l_shipdate")
        kind = lines.schema["l_shipdate"].dataType
        if first is not None:
            monday = F.lit(first - dt.timedelta(days=4)).cast(kind)
            lines = lines.filter((shipped >= monday) & (week >= F.lit(first)))
        if before is not None:
            next_monday = F.lit(before + dt.timedelta(days=3)).cast(kind)
            lines = lines.filter((shipped < next_monday) & (week < F.lit(before)))
        return (
            lines.select(
                _store_of_supplier("l_suppkey"),
                (F.col("l_partkey") % self.n_depts + 1).cast("int").alias("dept"),
                week.alias("date"),
                "l_extendedprice",
            )
            .groupBy("store", "dept", "date")
            .agg(exact_sum("l_extendedprice").alias("weekly_sales"))
        )

    def sales(self) -> DataFrame:
        """Raw sales: holiday text, and a second row with half the sales for some keys."""
        week = F.weekofyear("date")
        own = F.struct(
            F.col("weekly_sales"),
            F.when(week.isin(*HOLIDAY_WEEKS), "TRUE").otherwise("FALSE").alias("isholiday"),
        )
        half = F.struct(
            (F.col("weekly_sales") / 2).alias("weekly_sales"),
            F.lit("FALSE").alias("isholiday"),
        )
        doubled = (F.col("store") + F.col("dept") + week) % 17 == 0
        rows = F.when(doubled, F.array(own, half)).otherwise(F.array(own))
        return self.sales_base().select("store", "dept", "date", F.inline(rows))

    def sales_lines(self) -> DataFrame:
        """The raw sales as CSV lines, some of them with a wrong value, date, key or width."""
        kind = F.col("store") + F.col("dept") + F.weekofyear("date")
        store, dept = F.col("store").cast("string"), F.col("dept").cast("string")
        date = F.when(kind % 23 == 0, "not a date").otherwise(F.date_format("date", "MM/dd/yyyy"))
        written = F.when(kind % 2 == 0, F.date_format("date", "yyyy-MM-dd")).otherwise(date)
        amount = F.col("weekly_sales").cast("decimal(18,4)").cast("string")
        amount = F.when(kind % 29 == 0, "12x").when(kind % 19 == 0, "NA").otherwise(amount)
        store = F.when(kind % 37 == 0, "").otherwise(store)
        whole = F.concat_ws(",", store, dept, written, amount, "isholiday")
        return self.sales().select(
            F.when(kind % 31 == 0, F.concat_ws(",", store, dept)).otherwise(whole).alias("value")
        )

    def features(self) -> DataFrame:
        """One row per store and week; a markdown is null without orders of its priority."""
        price = F.col("o_totalprice").cast(MONEY)
        return (
            keep_complete(self._read("orders"), ["o_custkey", "o_orderdate"])
            .select(
                F.expr(f"cast(o_custkey div {CUSTOMERS_PER_STORE} + 1 as int)").alias("store"),
                week_friday("o_orderdate").alias("date"),
                "o_orderkey",
                "o_custkey",
                "o_orderpriority",
                price.alias("price"),
            )
            .groupBy("store", "date")
            .agg(
                F.min(F.col("o_orderkey") % 100).cast("double").alias("temperature"),
                (2.5 + (F.count(F.lit(1)) % 100).cast("double") / 100).alias("fuel_price"),
                (200 + F.max(F.col("o_custkey") % 500).cast("double") / 10).alias("cpi"),
                (5 + F.min(F.col("o_custkey") % 50).cast("double") / 10).alias("unemployment"),
                *[
                    F.sum(F.when(F.col("o_orderpriority").startswith(f"{i}-"), F.col("price")))
                    .cast("double")
                    .alias(name)
                    for i, name in enumerate(MARKDOWNS, start=1)
                ],
            )
        )

    def features_text(self) -> DataFrame:
        """The features as text: three date formats, an unparseable one, ``NA`` markdowns."""
        date, store = F.col("date"), F.col("store")
        written = (
            F.when(store % 4 == 0, F.date_format(date, "dd/MM/yyyy"))
            .when(store % 4 == 1, F.date_format(date, " yyyy-MM-dd"))
            .when(store % 4 == 2, F.date_format(date, "MM/dd/yyyy"))
            .otherwise("not a date")
        )
        return self.features().select(
            store.cast("string").alias("store"),
            written.alias("date"),
            *[
                F.coalesce(F.col(m).cast(MONEY).cast("string"), F.lit("NA")).alias(m)
                for m in MARKDOWNS
            ],
        )

    def stores(self) -> DataFrame:
        """Store dimension; the first of each five stores has size 0."""
        group = F.col("s_suppkey") % 5
        return self._read("supplier").select(
            _store_of_supplier("s_suppkey"),
            F.when(group < 2, "A").when(group < 4, "B").otherwise("C").alias("type"),
            (group * STORE_SIZE_STEP).cast("int").alias("size"),
        )

    def dates(self) -> DataFrame:
        return self._read("lineitem").select(F.col("l_shipdate").cast("date").alias("date"))

    def predictions(self) -> DataFrame:
        """Predictions for about 80% of the keys, off by -25% to +25%.

        The filter tests the computed value, so it stays above the aggregate and the scan
        of the sales is shared with the query that joins them.
        """
        store, dept, date = F.col("store"), F.col("dept"), F.col("date")
        covered = (store + dept + F.month(date)) % 5 != 0
        step = (store.cast("long") * 7 + dept * 3 + F.weekofyear(date)) % 51
        predicted = F.col("weekly_sales") * (0.75 + step.cast("double") / 100)
        return (
            self.sales_base()
            .select(
                "store", "dept", "date",
                F.when(covered, predicted).alias("predicted_weekly_sales"),
            )
            .filter(F.col("predicted_weekly_sales").isNotNull())
        )
