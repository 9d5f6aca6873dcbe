"""Whole runs from files to stored tables: ingest, forecasts, star schema, checks.

Each run reads stored tables and writes stored tables, so runs can be repeated alone and no
table is computed twice. Tables live in three layers under one folder, or in databases of
the same names when no folder is given.
"""

from __future__ import annotations

import datetime as dt
from contextlib import nullcontext
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from shelfcast.operators import quality
from shelfcast.operators.cleaning import SALES_KEY
from shelfcast.operators.series import off_grid_rows
from shelfcast.plans import features, models, series_models, star
from shelfcast.session import scratch
from shelfcast.sources import schemas, tables

RAW, STAGING, ANALYTICS = "raw", "staging", "analytics"

# Default training cut and last future week, and the range of the
# per-series forecast.
CUT = dt.date(2012, 11, 2)
LAST_WEEK = dt.date(2013, 10, 26)
SERIES_FIRST = dt.date(2010, 7, 1)
SERIES_LAST = dt.date(2013, 10, 26)
HOLDOUT = 13
ALL_MODELS = ("random_forest", "gbt", "linear_regression")


@dataclass(frozen=True)
class Layers:
    """Where the tables of each layer are, and what this run's writes counted.

    Catalog layers with ``buckets`` keep the tables that have one row per series and date bucketed
    by series, so lags, groups and joins of such tables need no shuffle. A good number gives
    buckets of some hundred megabytes; it must be the same for all tables of the layers.
    """

    spark: SparkSession
    root: str | None = None
    rows: dict[str, int] = field(default_factory=dict)  # written by the last write of each table
    nulls: dict[str, dict[str, int]] = field(default_factory=dict)  # and nulls of its required columns
    buckets: int | None = None

    def target(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}" if self.root else f"{layer}.{name}"

    def exists(self, layer: str, name: str) -> bool:
        return tables.exists(self.spark, self.target(layer, name))

    def read(self, layer: str, name: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        return tables.read_table(self.spark, self.target(layer, name), first, last)

    def write(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        run: str | None = None,
        required: list[str] | None = None,
        by_series: bool = False,
        **options,
    ) -> DataFrame:
        """Replaces the table, or only the rows of a run where one is named.

        Rows, and nulls of the required columns, are counted by the write itself. ``by_series``
        says that the table has one row per series and date.
        """
        if not self.root:
            self.spark.sql(f"create database if not exists {layer}")
        counted, seen = tables.count_rows(df, f"{layer}.{name}", required)
        target = self.target(layer, name)
        with tables.co_partitioned(self.spark) if self.buckets else nullcontext():
            if run is not None:
                tables.write_run(counted, target, run)
            elif by_series and self.buckets and not self.root:
                tables.write_series_table(counted, target, self.buckets, **options)
            else:
                tables.write_table(counted, target, **options)
        self.rows[f"{layer}.{name}"] = seen.get["rows"]
        if required:
            self.nulls[name] = {c: seen.get[f"null_{c}"] for c in required}
        return self.read(layer, name) if run is None else self.read_runs(layer, name, df.schema)

    def read_runs(self, layer: str, name: str, schema: StructType) -> DataFrame:
        """A table of runs with that schema; it may have no rows, hence no files."""
        if not self.root:
            return self.read(layer, name)
        with_run = StructType([*schema.fields]).add("run", StringType())
        return self.spark.read.schema(with_run).parquet(self.target(layer, name))


def ingest(layers: Layers, stores_csv: str, features_csv: str, sales_csv: str) -> DataFrame:
    """Files to raw tables, raw tables to the feature table.

    Lines that cannot be read as declared go to ``rejected_lines`` with table and reason, so every
    line of a file is either in its raw table or there.
    """
    files = {
        "stg_stores": (stores_csv, schemas.RAW_STORES, ["store"]),
        "stg_features": (features_csv, schemas.RAW_FEATURES, ["store", "date"]),
        "stg_sales": (sales_csv, schemas.RAW_SALES, SALES_KEY),
    }
    raw, wrong = {}, []
    for name, (path, schema, keys) in files.items():
        accepted, rejected = tables.read_lines(layers.spark, path, schema, keys)
        if name == "stg_features":  # its holiday column would clash with that of sales
            accepted = accepted.drop("isholiday")
        raw[name] = layers.write(accepted, RAW, name)
        wrong.append(rejected.select(F.lit(name).alias("table"), "line", "reason"))
    layers.write(reduce(DataFrame.unionByName, wrong), RAW, "rejected_lines")
    table = features.retail_features(raw["stg_sales"], raw["stg_features"], raw["stg_stores"])
    return layers.write(table, STAGING, "retail_features", by_series=True, partition_by=["year"])


def forecast_future(
    layers: Layers,
    cut: dt.date = CUT,
    horizon: int = 52,
    names: tuple[str, ...] = ALL_MODELS,
) -> tuple[DataFrame, DataFrame]:
    """Choose a model on the last weeks before the cut, refit it up to the cut, and recurse.

    Returns the scores of the models and the stored forecast.
    """
    table = layers.read(STAGING, "retail_features", last=cut)
    earlier = cut - dt.timedelta(weeks=HOLDOUT)
    held_out = models.test_rows(table, earlier, until=cut)
    scores = layers.write(
        models.compare(models.fit(list(names), table, earlier), held_out), ANALYTICS, "model_scores"
    )
    best = scores.filter("is_best = 1").first()["model"]
    final = models.fit([best], table, cut)[best]
    with scratch(layers.spark):
        forecast = models.forecast_recursive(final, table, cut, horizon)
        stored = layers.write(forecast, ANALYTICS, "weekly_sales_recursive", by_series=True)
    return scores, stored


def forecast_bulk(
    layers: Layers,
    cut: dt.date = CUT,
    last: dt.date = LAST_WEEK,
    name: str = "gbt",
    conditions: DataFrame | None = None,
) -> DataFrame:
    """Every future week in one pass with frozen lags; known future conditions replace held ones."""
    table = layers.read(STAGING, "retail_features", last=cut)
    model = models.fit([name], table, cut)[name]
    forecast = models.forecast_direct(model, table, cut, last, conditions)
    return layers.write(forecast, ANALYTICS, "weekly_sales_direct", by_series=True)


def forecast_each_series(
    layers: Layers,
    first: dt.date = SERIES_FIRST,
    last: dt.date = SERIES_LAST,
    horizon: int = 122,
    origin: dt.date | None = None,
    run: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """A model per series, and its back-test added to the evaluation table as a run of its own.

    A run is named by its range unless given a name; repeating it replaces its rows. Rows off the
    Friday grid, which the models leave out, are counted per series.
    """
    sales = layers.read(STAGING, "retail_features", first, last)
    layers.write(off_grid_rows(sales), ANALYTICS, "off_grid_rows")
    forecast = layers.write(
        series_models.forecast_by_series(sales, horizon, origin=origin),
        ANALYTICS, "weekly_sales_by_series", by_series=True,
    )
    evaluation = series_models.backtest_by_series(sales)
    return forecast, layers.write(
        evaluation, ANALYTICS, "series_backtests", run=run or f"{first}_{last}"
    )


def build_star(layers: Layers, predictions: DataFrame) -> dict[str, DataFrame]:
    """Dimensions, fact and KPI tables; the KPIs read the stored fact.

    The writes count nulls of the columns that must have none, for ``check_star``.
    """
    table = layers.read(STAGING, "retail_features")
    sales = star.stg_sales(table)
    stores = star.stg_stores(layers.read(RAW, "stg_stores"))
    fact = layers.write(
        star.fct_sales_analytics(sales, star.stg_features(table), stores, predictions),
        ANALYTICS, "fct_sales_analytics", partition_by=["year"], required=NOT_NULL["fct_sales_analytics"],
    )
    built = {
        "dim_store": star.dim_store(stores),
        "dim_date": star.dim_date(fact),
        "kpi_total_sales_by_store": star.kpi_total_sales_by_store(fact),
        "kpi_monthly_sales_trend": star.kpi_monthly_sales_trend(fact),
        "kpi_prediction_accuracy": star.kpi_prediction_accuracy(fact),
    }
    stored = {
        name: layers.write(df, ANALYTICS, name, required=NOT_NULL.get(name)) for name, df in built.items()
    }
    return {"fct_sales_analytics": fact, **stored}


# The declared checks as model -> columns.
NOT_NULL = {
    "fct_sales_analytics": ["store", "dept", "date"],
    "dim_store": ["store_id"],
    "dim_date": ["date"],
    "kpi_total_sales_by_store": ["store"],
    "kpi_prediction_accuracy": ["store", "dept"],
}
UNIQUE = {"dim_store": ["store_id"], "dim_date": ["date"]}
# Beyond the declared ones: repeated predictions of a key would multiply its sales.
FACT_KEY = {"fct_sales_analytics": SALES_KEY}


def check_star(built: dict[str, DataFrame], layers: Layers | None = None) -> DataFrame:
    """Failures of every declared check and of the fact's key; all 0 when the models are sound.

    With the layers that built the tables, nulls are those their writes counted, and one job with
    one shuffle checks all keys. Without, every table is read for its nulls.
    """
    keys = [(m, key, built[m]) for m, key in {**UNIQUE, **FACT_KEY}.items()]
    if layers is None:
        nulls = [quality.not_null(built[m], m, columns) for m, columns in NOT_NULL.items()]
    else:
        counted = [(m, c, layers.nulls[m][c]) for m, columns in NOT_NULL.items() for c in columns]
        schema = "model string, column_name string, failures long"
        nulls = [layers.spark.createDataFrame(counted, schema)]
    return quality.all_checks([*nulls, quality.unique_keys(keys)])
