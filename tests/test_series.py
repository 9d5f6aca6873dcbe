import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import arma, series
from shelfcast.plans import baselines, series_models

START = dt.date(2010, 2, 5)


def ordered(df, *columns):
    return [tuple(r) for r in df.orderBy("store", "dept", "date").select(*columns).collect()]


def test_lags_and_means_look_back_within_the_series(weekly):
    df = weekly({(1, 1): [1, 2, 3, 4, 5], (1, 2): [10, 20]})
    rows = ordered(series.model_lags(df), "weekly_sales_lag1", "weekly_sales_lag3", "weekly_sales_rolling4")
    assert rows == [
        (None, None, None), (1.0, None, 1.0), (2.0, None, 1.5), (3.0, 1.0, 2.0), (4.0, 2.0, 2.5),
        (None, None, None), (10.0, None, 10.0),
    ]
    means = ordered(df.withColumn("m", series.rolling_mean()), "m")
    assert means[:5] == [(1.0,), (1.5,), (2.0,), (2.5,), (3.5,)]


def test_no_model_input_depends_on_its_own_week_or_later(weekly):
    base, changed = [1, 2, 3, 4, 5, 6], [1, 2, 3, 4, 50, 60]
    inputs = ["weekly_sales_lag1", "weekly_sales_lag2", "weekly_sales_lag3", "weekly_sales_rolling4"]
    a = ordered(series.model_lags(weekly({(1, 1): base})), *inputs)
    b = ordered(series.model_lags(weekly({(1, 1): changed})), *inputs)
    assert a[:5] == b[:5] and a[5] != b[5]


@pytest.mark.parametrize(
    "first, last, weeks", [("2012-11-02", "2013-10-26", 52), ("2011-07-01", "2013-10-26", 122)]
)
def test_weekly_spine(spark, first, last, weeks):
    dates = spark.range(1).select(series.weekly_dates(first, last).alias("d")).first()["d"]
    assert len(dates) == weeks and {d.weekday() for d in dates} == {4}


def test_future_grid_is_series_times_weeks(weekly):
    df = weekly({(1, 1): [1, 2], (1, 2): [3], (2, 1): [4]})
    grid = series.future_grid(df, "2012-11-02", "2013-10-26")
    assert grid.count() == 3 * 52 and grid.distinct().count() == 3 * 52


def test_future_frame_repeats_the_latest_row(weekly):
    df = weekly({(1, 1): [1, 2, None], (2, 1): [7]})
    rows = ordered(series.future_frame(df, ["weekly_sales"], "2012-11-02", "2012-11-09"), "store", "weekly_sales", "week")
    assert rows == [(1, None, 44), (1, None, 45), (2, 7.0, 44), (2, 7.0, 45)]


def test_gap_fill(spark):
    rows = [
        (1, 1, dt.date(2010, 2, 3), 99.0),  # Wednesday, off the grid
        (1, 1, dt.date(2010, 2, 5), 1.0),
        (1, 1, dt.date(2010, 2, 19), None),  # missing value
        (1, 1, dt.date(2010, 2, 26), 4.0),
        (1, 1, dt.date(2010, 3, 13), 99.0),  # Saturday: the grid ends the day before
        (2, 1, dt.date(2010, 2, 5), 8.0),
        (3, 1, dt.date(2010, 2, 3), 8.0),  # nothing on the grid
    ]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double")
    filled = ordered(series.fill_weekly_gaps(df), "store", "date", "weekly_sales", "is_filled")
    assert filled == [
        (1, dt.date(2010, 2, 5), 1.0, 0),
        (1, dt.date(2010, 2, 12), 1.0, 1),
        (1, dt.date(2010, 2, 19), 1.0, 1),
        (1, dt.date(2010, 2, 26), 4.0, 0),
        (1, dt.date(2010, 3, 5), 4.0, 1),
        (1, dt.date(2010, 3, 12), 4.0, 1),
        (2, dt.date(2010, 2, 5), 8.0, 0),
    ]
    dropped = {r["store"]: r["off_grid_rows"] for r in series.off_grid_rows(df).collect()}
    assert dropped == {1: 2, 2: 0, 3: 1}


def test_eligibility(weekly):
    df = weekly({
        (1, 1): [1] * 29, (1, 2): [1] * 30, (2, 1): [0] * 15 + [1] * 15, (2, 2): [0] * 16 + [1] * 14,
    })
    kept = {(r["store"], r["dept"]) for r in series.forecastable_series(df).collect()}
    assert kept == {(1, 2), (2, 1)}


def test_holdout_needs_more_than_twenty_points(weekly):
    df = weekly({(1, 1): range(20), (1, 2): range(21)})
    counts = {
        r["dept"]: r["n"]
        for r in series.mark_holdout(df).groupBy("dept").agg(F.sum("is_test").alias("n")).collect()
    }
    assert counts == {1: 0, 2: 13}


def test_drift_of_a_line_is_exact(weekly):
    df = weekly({(1, 1): [5 + 2 * i for i in range(10)], (1, 2): [3]})
    rows = ordered(baselines.drift(df, horizon=3), "dept", "predicted_weekly_sales")
    assert rows == [(1, 25.0), (1, 27.0), (1, 29.0), (2, 3.0), (2, 3.0), (2, 3.0)]


def test_seasonal_naive_repeats_the_season(weekly):
    values = list(range(60))
    df = weekly({(1, 1): values, (1, 2): [1, 2, 3]})
    rows = ordered(baselines.seasonal_naive(df, horizon=60), "dept", "date", "predicted_weekly_sales")
    long = [r for r in rows if r[0] == 1]
    assert [r[2] for r in long] == [float(v) for v in values[8:] + values[8:16]]
    assert [r[1] for r in long] == [START + dt.timedelta(weeks=60 + i) for i in range(60)]
    short = [r[2] for r in rows if r[0] == 2]
    assert short[:49] == [3.0] * 49 and short[49:52] == [1.0, 2.0, 3.0]


def test_ar1_on_differences_matches_step_by_step(weekly):
    rng = np.random.default_rng(1)
    y = np.cumsum(rng.normal(0, 5, 60)) + 100
    forecast = ordered(baselines.ar1_on_differences(weekly({(1, 1): y, (1, 2): [4, 6]}), 8), "dept", "predicted_weekly_sales")
    d = np.diff(y)
    b, a = np.polyfit(d[:-1], d[1:], 1)
    expected, last, step = [], y[-1], d[-1]
    for _ in range(8):
        step = a + b * step
        last += step
        expected.append(last)
    assert [p for dept, p in forecast if dept == 1] == pytest.approx(expected)
    assert [p for dept, p in forecast if dept == 2] == [6.0] * 8


def test_accuracy_with_zero_actuals(spark):
    scored = spark.createDataFrame(
        [(1, 1, 0.0, 3.0), (1, 1, 0.0, -3.0), (2, 1, 0.0, 1.0), (2, 1, 4.0, 5.0)],
        "store int, dept int, y double, p double",
    )
    rows = {r["store"]: r for r in baselines.accuracy_by_series(scored, "y", "p").collect()}
    assert rows[1]["rmse"] == 3.0 and rows[1]["mape"] is None
    assert rows[2]["rmse"] == 1.0 and rows[2]["mape"] == 0.25


# --- per-series models --------------------------------------------------------------


def test_arma_recovers_an_autoregression():
    rng = np.random.default_rng(3)
    y = [0.0, 0.0]
    for _ in range(400):
        y.append(0.6 * y[-1] - 0.3 * y[-2] + rng.normal(0, 0.1))
    y = 50 + np.array(y[2:])
    expected = [50 + 0.6 * (y[-1] - 50) - 0.3 * (y[-2] - 50)]
    expected.append(50 + 0.6 * (expected[0] - 50) - 0.3 * (y[-1] - 50))
    assert arma.forecast(y, 2, season=1000) == pytest.approx(expected, abs=0.08)


def test_arma_follows_a_season():
    t = np.arange(52 * 6)
    rng = np.random.default_rng(5)
    y = 100 + 40 * np.sin(2 * np.pi * t / 52) + rng.normal(0, 1, len(t))
    future = np.arange(len(t), len(t) + 52)
    expected = 100 + 40 * np.sin(2 * np.pi * future / 52)
    assert np.sqrt(np.mean((arma.forecast(y, 52) - expected) ** 2)) < 6


@pytest.mark.parametrize("y", [[5.0] * 40, [1.0, 2.0, 3.0], list(range(35)), [0, 1] * 20])
def test_arma_always_answers(y):
    forecast = arma.forecast(np.array(y, dtype=float), 122)
    assert len(forecast) == 122 and np.isfinite(forecast).all()


def test_forecast_by_series_skips_and_dates(weekly):
    rng = np.random.default_rng(7)
    df = weekly({
        (1, 1): 100 + rng.normal(0, 5, 60), (1, 2): [1.0] * 29, (2, 1): [0.0] * 40 + [1.0] * 20,
    })
    rows = ordered(series_models.forecast_by_series(df, horizon=10), "store", "dept", "date", "predicted_weekly_sales")
    assert {r[:2] for r in rows} == {(1, 1)}
    assert [r[2] for r in rows] == [START + dt.timedelta(weeks=60 + i) for i in range(10)]
    assert all(abs(r[3] - 100) < 30 for r in rows)


def test_forecast_by_series_since_a_cut(weekly):
    df = weekly({(1, 1): np.linspace(1, 200, 150), (1, 2): np.linspace(1, 50, 45)})
    cut = START + dt.timedelta(weeks=130)
    rows = series_models.forecast_by_series(df, horizon=2, cut=cut, months=24).collect()
    assert {r["dept"] for r in rows} == {1}


def test_backtest_beats_nothing_but_is_finite(weekly):
    t = np.arange(200)
    rng = np.random.default_rng(11)
    smooth = 1000 + 3 * t + rng.normal(0, 2, 200)
    df = weekly({(1, 1): smooth, (1, 2): [1.0] * 20})
    rows = series_models.backtest_by_series(df).collect()
    assert [(r["store"], r["dept"]) for r in rows] == [(1, 1)]
    spread = float(np.std(smooth[-13:] - smooth[:-13].mean()) + abs(smooth[-13:].mean() - smooth[:-13].mean()))
    assert rows[0]["rmse"] < spread / 4 and 0 < rows[0]["mape"] < 0.1


def test_gap_fill_and_group_share_one_shuffle(weekly):
    df = weekly({(1, 1): range(60)})
    plan = series_models.forecast_by_series(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_backtest_scores_observed_weeks_only(spark, weekly):
    """A gap inside the last weeks moves the hold-out back; filled weeks are never scored."""
    values = [float(v) for v in range(100, 180)]
    gap = [i for i in range(len(values)) if not 68 <= i < 76]
    whole = weekly({(1, 1): values})
    first = whole.agg(F.min("date")).first()[0]
    df = whole.filter((F.datediff("date", F.lit(first)) / 7).isin(gap))
    regular = series.fill_weekly_gaps(df)
    got = baselines.backtest_seasonal_naive(regular).collect()[0]
    # The last 13 observed weeks, each 52 above the value a year before.
    assert got["rmse"] == pytest.approx(52.0)
    naive = series_models.backtest_by_series(df, method=lambda y, h: np.full(h, y[-1])).collect()[0]
    held = [i for i in gap][-13:]
    last = values[held[0] - 1]
    expected = (sum((values[i] - last) ** 2 for i in held) / 13) ** 0.5
    assert naive["rmse"] == pytest.approx(expected)


def test_series_reach_python_many_at_a_time(weekly):
    """A group per series costs several times its model; models see whole series, in order."""
    rng = np.random.default_rng(3)
    values = {(s, d): 100 + rng.normal(0, 5, 40 + s) for s in range(1, 30) for d in (1, 2)}
    forecast = series_models.forecast_by_series(weekly(values), horizon=3)
    plan = forecast._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsIn" not in plan
    got = {}
    for *key, predicted in ordered(forecast, "store", "dept", "predicted_weekly_sales"):
        got.setdefault(tuple(key), []).append(predicted)
    assert got.keys() == values.keys()
    assert all(got[k] == pytest.approx(arma.forecast(y, 3)) for k, y in values.items())


def test_per_series_models_without_a_usable_series(weekly):
    df = weekly({(1, 1): [1.0] * 5})
    assert series_models.forecast_by_series(df).collect() == []
    assert series_models.backtest_by_series(df).collect() == []


def test_gap_fill_and_hold_out_share_their_sorts(weekly):
    """One sort before the gaps are filled and one after, whatever windows follow."""
    regular = series.fill_weekly_gaps(weekly({(1, 1): range(90)}))
    plan = baselines.backtest_seasonal_naive(regular)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2


def test_hold_out_marks_the_newest_weeks(weekly):
    df = weekly({(1, 1): range(30), (1, 2): range(20)})
    rows = ordered(series.mark_holdout(df, 4), "dept", "points", "is_test")
    assert rows == [(1, 30, int(i >= 26)) for i in range(30)] + [(2, 20, 0)] * 20
