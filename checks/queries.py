"""Every registered query as a function of the input tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import columns
from shelfcast.operators import cleaning, quality, series
from shelfcast.plans import (
    autoregression,
    baselines,
    features,
    linear,
    models,
    origins,
    reports,
    series_models,
    star,
)
from shelfcast.session import shared
from shelfcast.sources import schemas, tables
from shelfcast.sources.fixtures import RetailInputs

# Dates fitting the given tables, whose sales run from 1995-01 to 2001-11.
CUT = dt.date(2001, 1, 5)
# Models are chosen on the year before the cut.
CHOICE_CUT = dt.date(2000, 1, 7)
GRID = (dt.date(2001, 1, 5), dt.date(2001, 12, 28))
TREND_ORIGIN = dt.date(1995, 1, 6)
HISTORY_CUT = dt.date(1997, 3, 1)

QUERIES: dict[str, Callable[[RetailInputs], DataFrame]] = {}


def query(fn: Callable[[RetailInputs], DataFrame]) -> Callable[[RetailInputs], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Averages differ in the last bits between engines; adding 0 clears a negative zero."""
    return df.withColumns({c: F.round(c, digits) + 0.0 for c in names})


# --- lines of files -----------------------------------------------------------------


def _sales_lines(x: RetailInputs) -> DataFrame:
    return tables.parse_lines(x.sales_lines(), schemas.RAW_SALES, cleaning.SALES_KEY)


@query
def accepted_lines(x: RetailInputs) -> DataFrame:
    return _sales_lines(x).filter(F.col("reason").isNull()).drop("line", "reason")


@query
def rejected_lines(x: RetailInputs) -> DataFrame:
    return _sales_lines(x).filter(F.col("reason").isNotNull()).select("line", "reason")


# --- staging, dimensions, fact ------------------------------------------------------


@query
def stg_sales(x: RetailInputs) -> DataFrame:
    return star.stg_sales(x.sales())


@query
def stg_stores(x: RetailInputs) -> DataFrame:
    return star.stg_stores(x.stores())


def _raw_features(x: RetailInputs) -> DataFrame:
    """Conditions at the grain of the raw sales, as the feature table repeats them."""
    return features.with_conditions(x.sales(), x.features())


@query
def stg_features(x: RetailInputs) -> DataFrame:
    return star.stg_features(_raw_features(x))


@query
def stg_features_literal(x: RetailInputs) -> DataFrame:
    return star.stg_features_literal(_raw_features(x))


@query
def dim_store(x: RetailInputs) -> DataFrame:
    return star.dim_store(star.stg_stores(x.stores()))


@query
def dim_date(x: RetailInputs) -> DataFrame:
    return star.dim_date(x.dates())


@query
def fct_sales_analytics(x: RetailInputs) -> DataFrame:
    # Reducing the raw features to one row per key gives the same join partners as reducing
    # the feature table built from them.
    return star.fct_sales_analytics(
        star.stg_sales(x.sales()),
        star.stg_features(x.features()),
        star.stg_stores(x.stores()),
        x.predictions(),
    )


@query
def fct_sales_analytics_literal(x: RetailInputs) -> DataFrame:
    return star.fct_sales_analytics(
        star.stg_sales(x.sales()),
        star.stg_features_literal(_raw_features(x)),
        star.stg_stores(x.stores()),
        x.predictions(),
        literal=True,
    )


@query
def fct_actual(x: RetailInputs) -> DataFrame:
    return star.fct_actual(fct_sales_analytics(x))


@query
def fct_predicted(x: RetailInputs) -> DataFrame:
    return star.fct_predicted(fct_sales_analytics(x))


@query
def kpi_total_sales_by_store(x: RetailInputs) -> DataFrame:
    return star.kpi_total_sales_by_store(fct_sales_analytics(x))


@query
def kpi_total_sales_by_store_literal(x: RetailInputs) -> DataFrame:
    return star.kpi_total_sales_by_store(fct_sales_analytics_literal(x), literal=True)


@query
def kpi_monthly_sales_trend(x: RetailInputs) -> DataFrame:
    return star.kpi_monthly_sales_trend(fct_sales_analytics(x))


@query
def kpi_monthly_sales_trend_literal(x: RetailInputs) -> DataFrame:
    return star.kpi_monthly_sales_trend(fct_sales_analytics_literal(x), literal=True)


_ACCURACY = (
    "avg_absolute_error_percentage", "avg_error_percentage", "stddev_error_percentage",
)


@query
def kpi_prediction_accuracy(x: RetailInputs) -> DataFrame:
    return rounded(star.kpi_prediction_accuracy(fct_sales_analytics(x)), 6, *_ACCURACY)


@query
def kpi_prediction_accuracy_literal(x: RetailInputs) -> DataFrame:
    accuracy = star.kpi_prediction_accuracy(fct_sales_analytics_literal(x), literal=True)
    return rounded(accuracy, 6, *_ACCURACY)


# --- reports ------------------------------------------------------------------------


@query
def actual_vs_predicted_trend(x: RetailInputs) -> DataFrame:
    return reports.actual_vs_predicted_trend(fct_sales_analytics(x))


@query
def performance_by_store(x: RetailInputs) -> DataFrame:
    return rounded(
        reports.performance(fct_sales_analytics(x), "store"), 6, "avg_absolute_error_percentage"
    )


@query
def performance_by_dept(x: RetailInputs) -> DataFrame:
    return rounded(
        reports.performance(fct_sales_analytics(x), "dept"), 6, "avg_absolute_error_percentage"
    )


@query
def sales_cards(x: RetailInputs) -> DataFrame:
    return rounded(reports.sales_cards(fct_sales_analytics(x)), 4, "average_sales")


@query
def monthly_pct_change(x: RetailInputs) -> DataFrame:
    return rounded(reports.monthly_pct_change(kpi_monthly_sales_trend(x)), 6, "pct_change")


@query
def top_departments(x: RetailInputs) -> DataFrame:
    return reports.top_departments(fct_sales_analytics(x))


# --- data quality -------------------------------------------------------------------


@query
def dq_not_null(x: RetailInputs) -> DataFrame:
    fact = fct_sales_analytics(x)
    return quality.all_checks(
        [
            quality.not_null(fact, "fct_sales_analytics", ["store", "dept", "date", "temperature"]),
            quality.not_null(dim_store(x), "dim_store", ["store_id"]),
            quality.not_null(dim_date(x), "dim_date", ["date"]),
            quality.not_null(
                star.kpi_total_sales_by_store(fact), "kpi_total_sales_by_store", ["store"]
            ),
            quality.not_null(
                star.kpi_prediction_accuracy(fact), "kpi_prediction_accuracy", ["store", "dept"]
            ),
        ]
    )


@query
def dq_unique(x: RetailInputs) -> DataFrame:
    return quality.all_checks(
        [
            quality.unique(dim_store(x), "dim_store", ["store_id"]),
            quality.unique(dim_date(x), "dim_date", ["date"]),
            quality.unique(x.sales(), "raw_sales", ["store", "dept", "date"]),
        ]
    )


@query
def dq_unique_keys(x: RetailInputs) -> DataFrame:
    return quality.unique_keys(
        [
            ("dim_store", ["store_id"], dim_store(x)),
            ("dim_date", ["date"], dim_date(x)),
            ("raw_sales", ["store", "dept", "date"], x.sales()),
            ("raw_features", ["store", "date"], x.features()),
            ("fct_sales_analytics", ["store", "dept", "date"], fct_sales_analytics(x)),
        ]
    )


# --- cleaning and features ----------------------------------------------------------


@query
def parse_mixed_dates(x: RetailInputs) -> DataFrame:
    raw = x.features_text()
    return raw.select("store", F.col("date").alias("text"), columns.parse_mixed_date("date").alias("date"))


@query
def total_markdown(x: RetailInputs) -> DataFrame:
    totals = features.total_markdown(x.features_text())
    return rounded(totals.select("store", "date", "total_markdown"), 2, "total_markdown")


@query
def holiday_flag(x: RetailInputs) -> DataFrame:
    return x.sales().select(
        "store", "dept", "date", "weekly_sales",
        columns.holiday_flag("isholiday").alias("staged_flag"),
        columns.holiday_flag(F.lower("isholiday"), ("TRUE",)).alias("ingested_flag"),
    )


@query
def fill_by_type(x: RetailInputs) -> DataFrame:
    joined = features.enrich_sales(x.sales(), x.features(), x.stores())
    untyped = joined.withColumn("type", F.when(F.col("size") > 0, F.col("type")))
    return cleaning.fill_by_type(untyped)


@query
def impute_mean(x: RetailInputs) -> DataFrame:
    conditions = star.CONDITIONS
    joined = series.sales_lags(x.sales_base(), lags=1).join(
        x.features().select("store", "date", *conditions), ["store", "date"], "left"
    )
    filled = cleaning.impute(
        joined, zero=["weekly_sales_lag1"], mean=conditions, training=cleaning.before(joined, CUT)
    )
    return rounded(filled, 6, *conditions)


@query
def enrich_sales(x: RetailInputs) -> DataFrame:
    return features.enrich_sales(x.sales(), x.features(), x.stores())


@query
def scaled_econ(x: RetailInputs) -> DataFrame:
    scaled = features.scaled_economy(x.sales_base(), x.features())
    return rounded(scaled, 6, *[f"{c}_scaled" for c in features.ECONOMY])


@query
def retail_features(x: RetailInputs) -> DataFrame:
    table = features.retail_features(x.sales(), x.features(), x.stores())
    return rounded(
        rounded(table, 6, *[f"{c}_scaled" for c in features.ECONOMY]),
        4, "weekly_sales_rolling4", "total_markdown",
    )


@query
def train_split_by_date(x: RetailInputs) -> DataFrame:
    return cleaning.before(x.sales_base(before=CUT), CUT)


@query
def sales_between_dates(x: RetailInputs) -> DataFrame:
    first, last = GRID
    return cleaning.between_days(x.sales_base(first, last + dt.timedelta(days=1)), first, last)


@query
def filter_equals(x: RetailInputs) -> DataFrame:
    return star.stg_sales(x.sales()).filter(F.col("isholiday") == 1)


@query
def union_all_rows(x: RetailInputs) -> DataFrame:
    """Stacked actual and predicted rows."""
    actual = x.sales_base().select(
        "store", "dept", "date", F.lit("actual").alias("kind"), F.col("weekly_sales").alias("sales")
    )
    predicted = x.predictions().select(
        "store", "dept", "date", F.lit("predicted").alias("kind"),
        F.col("predicted_weekly_sales").alias("sales"),
    )
    return actual.unionByName(predicted)


# --- series -------------------------------------------------------------------------


@query
def sales_lags(x: RetailInputs) -> DataFrame:
    return series.sales_lags(x.sales_base())


@query
def rolling_mean_4(x: RetailInputs) -> DataFrame:
    means = x.sales_base().withColumns(
        {
            "rolling_mean": series.rolling_mean(),
            "rolling_mean_before": series.rolling_mean(first=-4, last=-1),
        }
    )
    return rounded(means, 4, "rolling_mean", "rolling_mean_before")


@query
def distinct_series(x: RetailInputs) -> DataFrame:
    return series.distinct_series(x.sales())


@query
def future_grid(x: RetailInputs) -> DataFrame:
    return series.future_grid(cleaning.before(x.sales_base(before=CUT), CUT), *GRID)


@query
def last_known_values(x: RetailInputs) -> DataFrame:
    lagged = series.sales_lags(x.sales_base(before=CUT))
    known = ["weekly_sales", *[f"weekly_sales_lag{i}" for i in (1, 2, 3)]]
    return series.last_known(cleaning.before(lagged, CUT), known)


@query
def future_frame(x: RetailInputs) -> DataFrame:
    joined = x.sales_base(before=CUT).join(
        x.features().select("store", "date", "temperature", "cpi"), ["store", "date"], "left"
    )
    return series.future_frame(
        cleaning.before(joined, CUT), ["weekly_sales", "temperature", "cpi"], *GRID
    )


def _regular(x: RetailInputs) -> DataFrame:
    return series.fill_weekly_gaps(x.sales_base())


@query
def weekly_gap_fill(x: RetailInputs) -> DataFrame:
    return _regular(x)


@query
def forecastable_series(x: RetailInputs) -> DataFrame:
    return series.forecastable_series(_regular(x), cut=HISTORY_CUT)


@query
def holdout_split(x: RetailInputs) -> DataFrame:
    return series.mark_holdout(x.sales_base())


@query
def train_test_split(x: RetailInputs) -> DataFrame:
    return cleaning.hash_split(x.sales_base(), cleaning.SALES_KEY, 80, seed=42)


@query
def calendar_fields(x: RetailInputs) -> DataFrame:
    fields = columns.calendar("date")
    return x.sales_base().select("store", "dept", "date", *[c.alias(n) for n, c in fields.items()])


# --- closed-form forecasts ----------------------------------------------------------


@query
def forecast_seasonal_naive(x: RetailInputs) -> DataFrame:
    return baselines.seasonal_naive(series.fill_weekly_gaps(x.sales_base()))


@query
def forecast_drift(x: RetailInputs) -> DataFrame:
    return baselines.drift(series.fill_weekly_gaps(x.sales_base()))


@query
def forecast_ar1_diff(x: RetailInputs) -> DataFrame:
    forecast = baselines.ar1_on_differences(series.fill_weekly_gaps(x.sales_base()))
    return rounded(forecast, 4, "predicted_weekly_sales")


@query
def forecast_autoregression(x: RetailInputs) -> DataFrame:
    forecast = autoregression.forecast_autoregression(_regular(x), horizon=122)
    return rounded(forecast, 3, "predicted_weekly_sales")


@query
def trend_regression(x: RetailInputs) -> DataFrame:
    return rounded(
        baselines.trend_regression(x.sales_base(), TREND_ORIGIN), 5, "slope", "intercept", "r2"
    )


@query
def forecast_accuracy_by_series(x: RetailInputs) -> DataFrame:
    scored = baselines.backtest_seasonal_naive(series.fill_weekly_gaps(x.sales_base()))
    return rounded(scored, 6, "rmse", "mape")


@query
def forecast_errors_by_horizon(x: RetailInputs) -> DataFrame:
    errors = origins.errors_by_horizon(_regular(x))
    return rounded(errors, 6, *[f"{kind}_{m}" for kind in ("rmse", "mae") for m in origins.METHODS])


@query
def regression_metrics(x: RetailInputs) -> DataFrame:
    scored = x.sales_base().join(x.predictions(), cleaning.SALES_KEY)
    metrics = models.regression_metrics(scored, "weekly_sales", "predicted_weekly_sales", ["store"])
    return rounded(metrics, 6, "rmse", "r2")


# --- fitted models ------------------------------------------------------------------


ALL_MODELS = ["random_forest", "gbt", "linear_regression"]


def _features(x: RetailInputs) -> DataFrame:
    """The feature table as written once: training, scoring and forecasts of all queries read it."""
    return shared(
        "retail_features", x.folder, x.spark,
        lambda: features.retail_features(x.sales(), x.features(), x.stores()),
    )


@query
def predict_rf(x: RetailInputs) -> DataFrame:
    return models.predict("random_forest", _features(x), CUT, stored=True)


@query
def predict_gbt(x: RetailInputs) -> DataFrame:
    return models.predict("gbt", _features(x), CUT, stored=True)


@query
def predict_lr(x: RetailInputs) -> DataFrame:
    return rounded(linear.predict(_features(x), CUT), 2, "predicted_weekly_sales")


@query
def model_selection(x: RetailInputs) -> DataFrame:
    table = _features(x)
    return models.compare(models.fit(ALL_MODELS, table, CUT, stored=True), models.test_rows(table, CUT))


@query
def cross_validate(x: RetailInputs) -> DataFrame:
    return rounded(linear.cross_validate(_features(x), dt.date(2000, 4, 7)), 4, "rmse", "r2")


@query
def forecast_direct(x: RetailInputs) -> DataFrame:
    table = _features(x)
    return models.forecast_direct(models.fit(["gbt"], table, CUT, stored=True)["gbt"], table, *GRID)


@query
def forecast_recursive(x: RetailInputs) -> DataFrame:
    """Chooses a model on the weeks before the cut, refits it on all of them, then forecasts."""
    table = _features(x)
    fitted = models.fit(ALL_MODELS, table, CHOICE_CUT, stored=True)
    best = models.best_model(fitted, models.test_rows(table, CHOICE_CUT, until=CUT))
    return models.forecast_recursive(models.fit([best], table, CUT, stored=True)[best], table, CUT)


@query
def forecast_recursive_linear(x: RetailInputs) -> DataFrame:
    table = _features(x)
    line = models.fit(["linear_regression"], table, CUT, stored=True)["linear_regression"]
    return models.forecast_recursive(line, table, CUT)


@query
def forecast_recursive_forest(x: RetailInputs) -> DataFrame:
    """The step-by-step recursion whichever model is best."""
    table = _features(x)
    forest = models.fit(["random_forest"], table, CUT, stored=True)["random_forest"]
    return models.forecast_recursive(forest, table, CUT)


@query
def forecast_by_series(x: RetailInputs) -> DataFrame:
    return series_models.forecast_by_series(x.sales_base())


@query
def backtest_by_series(x: RetailInputs) -> DataFrame:
    return series_models.backtest_by_series(x.sales_base())
