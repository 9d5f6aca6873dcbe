"""The whole way from files to checked models."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.series import sales_lags
from shelfcast.plans import jobs, star
from shelfcast.sources import tables

FIRST = dt.date(2010, 2, 5)
WEEKS = 150
CUT = FIRST + dt.timedelta(weeks=WEEKS)


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    days = [FIRST + dt.timedelta(weeks=i) for i in range(WEEKS)]
    (folder / "stores.csv").write_text("Store,Type,Size\n1,A,1000\n2,B,0\n")
    with open(folder / "features.csv", "w") as out:
        out.write(
            "Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,MarkDown5,"
            "CPI,Unemployment,IsHoliday\n"
        )
        for store in (1, 2):
            for i, day in enumerate(days):
                out.write(f"{store},{day:%d/%m/%Y},{i % 30},2.5,NA,{i},NA,NA,1,{200 + i / 10},8.1,FALSE\n")
    with open(folder / "sales.csv", "w") as out:
        out.write("Store,Dept,Date,Weekly_Sales,IsHoliday\n")
        for store in (1, 2):
            for dept in (1, 2):
                for i, day in enumerate(days):
                    amount = 1000 * store + 100 * dept + 50 * math.sin(i / 8) + (i * 7919 % 13)
                    out.write(f"{store},{dept},{day},{amount:.2f},{'TRUE' if i % 26 == 0 else 'FALSE'}\n")
        out.write("1,1,2010-02-05,lots,FALSE\n1,1,some day,5,FALSE\n")
    made = jobs.Layers(spark, str(tmp_path_factory.mktemp("layers")))
    jobs.ingest(made, *[str(folder / f"{name}.csv") for name in ("stores", "features", "sales")])
    return made


@pytest.fixture(scope="module")
def future(layers):
    names = ("linear_regression", "random_forest")
    return jobs.forecast_future(layers, cut=CUT, horizon=8, names=names)


def test_ingest_stores_every_layer(layers):
    assert layers.read("raw", "stg_sales").count() == 4 * WEEKS
    table = layers.read("staging", "retail_features")
    assert table.count() == 4 * WEEKS
    assert table.filter("total_markdown > 0").count() == 4 * WEEKS
    assert table.filter("isholiday = 'TRUE'").count() == table.filter("isholidayencoded = 1").count() > 0


def test_future_forecast_uses_the_best_model_and_stays_in_range(layers, future):
    scores, forecast = future
    assert scores.count() == 2 and scores.filter("is_best = 1").count() == 1
    rows = forecast.collect()
    assert len(rows) == 4 * 8 and min(r["date"] for r in rows) == CUT
    for r in rows:
        assert abs(r["predicted_weekly_sales"] - (1000 * r["store"] + 100 * r["dept"])) < 400


def test_bulk_forecast(layers):
    forecast = jobs.forecast_bulk(
        layers, cut=CUT, last=CUT + dt.timedelta(weeks=4), name="linear_regression"
    )
    assert forecast.count() == 4 * 5


def test_bulk_forecast_takes_known_conditions(layers):
    """Conditions replace the held ones where given, so only those weeks change."""
    weeks = [CUT + dt.timedelta(weeks=i) for i in range(3)]
    given = layers.spark.createDataFrame([(1, weeks[1], 1000.0)], "store int, date date, temperature double")
    args = {"cut": CUT, "last": weeks[2], "name": "linear_regression"}

    def forecast(**more):
        rows = jobs.forecast_bulk(layers, **args, **more).collect()
        return {(r["store"], r["dept"], r["date"]): r["predicted_weekly_sales"] for r in rows}

    plain, changed = forecast(), forecast(conditions=given)
    assert plain.keys() == changed.keys()
    differ = {k for k in plain if abs(plain[k] - changed[k]) > 1e-9}
    assert differ == {(1, dept, weeks[1]) for dept in (1, 2)}


def test_origin_dates_every_series_alike(layers):
    origin = CUT + dt.timedelta(weeks=4, days=2)
    forecast, _ = jobs.forecast_each_series(layers, FIRST, CUT, horizon=3, origin=origin)
    first = CUT + dt.timedelta(weeks=5)
    assert {r["date"] for r in forecast.select("date").collect()} == {first + dt.timedelta(weeks=i) for i in range(3)}


def test_a_repeated_evaluation_leaves_the_same_rows(layers):
    for _ in range(2):
        forecast, evaluation = jobs.forecast_each_series(layers, FIRST, CUT, horizon=6)
        assert forecast.count() == 4 * 6
        assert evaluation.filter(F.col("run") == f"{FIRST}_{CUT}").count() == 4
    others = evaluation.count()
    _, evaluation = jobs.forecast_each_series(layers, FIRST, CUT, horizon=6, run="second")
    assert evaluation.count() == others + 4
    assert evaluation.filter("run = 'second' and rmse < 60 and mape < 0.1").count() == 4
    assert layers.rows["analytics.weekly_sales_by_series"] == 4 * 6
    assert layers.read("analytics", "off_grid_rows").filter("off_grid_rows = 0").count() == 4


def test_ingest_counts_every_line(layers):
    assert layers.rows["raw.stg_sales"] == 4 * WEEKS and layers.rows["raw.rejected_lines"] == 2
    rejected = {(r["table"], r["line"], r["reason"]) for r in layers.read("raw", "rejected_lines").collect()}
    assert rejected == {
        ("stg_sales", "1,1,2010-02-05,lots,FALSE", "malformed"),
        ("stg_sales", "1,1,some day,5,FALSE", "unreadable date"),
    }


def test_star_is_built_and_sound(layers):
    past = layers.read("staging", "retail_features").selectExpr(
        "store", "dept", "date", "weekly_sales * 1.05 as predicted_weekly_sales"
    )
    built = jobs.build_star(layers, past)
    assert built["fct_sales_analytics"].count() == 4 * WEEKS
    assert built["dim_date"].count() == WEEKS
    assert built["kpi_prediction_accuracy"].filter("poor_predictions > 0").count() == 0
    failures = jobs.check_star(built).collect()
    assert len(failures) == 11 and all(r["failures"] == 0 for r in failures)
    counted = jobs.check_star(built, layers).collect()
    assert sorted(counted) == sorted(failures)


def test_writes_count_nulls_for_the_checks(layers, spark):
    """Nulls come from the write, keys from one more job, whatever the number of checks."""
    past = layers.read("staging", "retail_features").selectExpr(
        "store", "dept", "date", "weekly_sales as predicted_weekly_sales"
    )
    built = jobs.build_star(layers, past)
    rows = spark.createDataFrame([(None, "A", 1), (1, "A", 2), (1, "B", 3)], "store_id int, store_type string, store_size int")
    built["dim_store"] = layers.write(rows, "analytics", "dim_store", required=["store_id"])
    found = {(r["model"], r["column_name"], r["failures"]) for r in jobs.check_star(built, layers).collect()}
    assert {f for f in found if f[2]} == {("dim_store", "store_id", 1)}
    kinds = [(r["model"], r["column_name"], r["failures"]) for r in jobs.check_star(built, layers).collect()]
    assert kinds.count(("dim_store", "store_id", 1)) == 2  # one null, one repeated value
    assert layers.nulls["dim_store"] == {"store_id": 1}


def test_repeated_predictions_fail_the_fact_key(layers):
    past = layers.read("staging", "retail_features").selectExpr(
        "store", "dept", "date", "weekly_sales as predicted_weekly_sales"
    )
    built = jobs.build_star(layers, past.unionByName(past.filter("store = 1 and dept = 1")))
    failures = {(r["model"], r["column_name"]): r["failures"] for r in jobs.check_star(built).collect()}
    assert failures["fct_sales_analytics", "store,dept,date"] == WEEKS


def test_catalog_layers(spark):
    catalog = jobs.Layers(spark)
    catalog.write(spark.range(3), "staging", "three")
    assert spark.table("staging.three").count() == 3
    spark.sql("drop table staging.three")


def test_tables_in_buckets_need_no_shuffle_by_series(layers, spark):
    """Features, lags of them, and the fact's join with predictions stay in their buckets."""
    catalog = jobs.Layers(spark, buckets=4)
    table = layers.read("staging", "retail_features")
    names = ("staging.bucketed_features", "analytics.bucketed_predictions", "analytics.bucketed_fact")
    try:
        stored = catalog.write(table, "staging", "bucketed_features", by_series=True, partition_by=["year"])
        past = table.selectExpr("store", "dept", "date", "weekly_sales * 1.05 as predicted_weekly_sales")
        predictions = catalog.write(past, "analytics", "bucketed_predictions", by_series=True)
        assert catalog.rows["staging.bucketed_features"] == 4 * WEEKS == stored.count()

        def shuffles(df):
            plan = df._jdf.queryExecution().executedPlan().toString()
            return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "dept" in line]

        assert not shuffles(sales_lags(stored))
        stores = star.stg_stores(layers.read("raw", "stg_stores"))
        args = (star.stg_sales(stored), star.stg_features(stored), stores, predictions)
        with tables.co_partitioned(spark):
            fact = star.fct_sales_analytics(*args)
            assert not shuffles(fact)
        assert shuffles(star.fct_sales_analytics(star.stg_sales(table), star.stg_features(table), stores, past))
        written = catalog.write(fact, "analytics", "bucketed_fact")
        plain = star.fct_sales_analytics(star.stg_sales(table), star.stg_features(table), stores, past)
        assert written.exceptAll(plain).count() == 0 == plain.exceptAll(written).count()
        year = dt.date(FIRST.year, 12, 31)
        bounded = catalog.read("staging", "bucketed_features", last=year)
        assert "PartitionFilters: [isnotnull(year" in bounded._jdf.queryExecution().executedPlan().toString()
        assert bounded.exceptAll(stored.filter(F.col("date") <= year)).count() == 0
    finally:
        for name in names:
            spark.sql(f"drop table if exists {name}")
