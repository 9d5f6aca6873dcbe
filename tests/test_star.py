import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from shelfcast.operators import quality
from shelfcast.plans import reports, star

DAY = dt.date(2010, 2, 5)


@pytest.fixture(scope="module")
def small(spark):
    """Two stores (sizes 0 and 100), sales of 200, 0 and -5, one of them without prediction."""
    sales = spark.createDataFrame(
        [(1, 1, DAY, 200.0, "TRUE"), (2, 1, DAY, 200.0, "FALSE"), (2, 2, DAY, 0.0, "N"),
         (2, 3, DAY, -5.0, None), (3, 1, DAY, 10.0, "Y")],
        "store int, dept int, date date, weekly_sales double, isholiday string",
    )
    stores = spark.createDataFrame(
        [(1, "A", 0), (2, "B", 100), (3, "C", None), (None, "A", 5)], "store int, type string, size int"
    )
    features = spark.createDataFrame(
        [(2, DAY, 1.0, 2.0, 3.0, 4.0)] * 3,
        "store int, date date, temperature double, fuel_price double, cpi double, unemployment double",
    )
    predictions = spark.createDataFrame(
        [(2, 1, DAY, 210.0), (2, 2, DAY, 1.0), (2, 3, DAY, 1.0), (1, 1, DAY, 100.0)],
        "store int, dept int, date date, predicted_weekly_sales double",
    )
    return sales, features, stores, predictions


def fact(small, literal=False):
    sales, features, stores, predictions = small
    staged = star.stg_features_literal(features) if literal else star.stg_features(features)
    return star.fct_sales_analytics(
        star.stg_sales(sales), staged, star.stg_stores(stores), predictions, literal=literal
    )


def by_key(df):
    return {(r["store"], r["dept"]): r for r in df.collect()}


def test_guards(small):
    rows = by_key(fact(small))
    assert rows[1, 1]["actual_sales_per_sqft"] is None  # size 0
    assert rows[3, 1]["actual_sales_per_sqft"] is None  # size unknown
    assert rows[2, 1]["actual_sales_per_sqft"] == 2.0
    assert rows[2, 1]["predicted_sales_per_sqft"] == 2.1
    assert rows[2, 1]["prediction_error_percentage"] == pytest.approx(5.0)
    assert rows[2, 2]["prediction_error_percentage"] is None  # sales 0
    assert rows[2, 3]["prediction_error_percentage"] is None  # sales negative
    assert rows[2, 3]["prediction_error_absolute"] == 6.0


def test_a_missing_prediction_shows_as_zero_but_not_as_error(small):
    row = by_key(fact(small))[3, 1]
    assert row["predicted_weekly_sales"] == 0.0
    assert row["prediction_error_absolute"] is None
    predicted = star.fct_predicted(fact(small))
    assert predicted.count() == 4 and predicted.filter("store = 3").count() == 0


def test_default_fact_does_not_fan_out(small, inputs):
    assert fact(small).count() == 5
    sales, table = star.stg_sales(inputs.sales()), QUERIES["fct_sales_analytics"](inputs)
    assert table.count() == sales.count()


def test_literal_fact_counts_one_copy_per_features_row(small):
    """Q1: the documented join repeats a sale for each features row of its store and date."""
    rows = by_key(fact(small, literal=True))
    assert rows[2, 1]["copies"] == 3 and rows[1, 1]["copies"] == 1
    totals = {
        r["store"]: r["total_sales"]
        for r in star.kpi_total_sales_by_store(fact(small, literal=True), literal=True).collect()
    }
    assert totals == {1: 200.0, 2: 585.0, 3: 10.0}


def test_literal_holiday_flag_is_zero(small):
    """Q12: the literal flag compares an encoded flag with text."""
    assert {r["is_holiday_flag"] for r in fact(small, literal=True).collect()} == {0}
    assert by_key(fact(small))[1, 1]["is_holiday_flag"] == 1


def test_literal_monthly_trend_sums_all_copies(inputs):
    """Q1 for the monthly KPI."""
    literal = QUERIES["kpi_monthly_sales_trend_literal"](inputs).agg(F.sum("total_sales")).first()[0]
    copies = QUERIES["fct_sales_analytics_literal"](inputs).agg(
        F.sum(F.col("actual_weekly_sales") * F.col("copies"))
    ).first()[0]
    assert literal == pytest.approx(copies)


def test_kpi_sums_equal_the_fact(inputs):
    total = QUERIES["fct_sales_analytics"](inputs).agg(F.sum("actual_weekly_sales")).first()[0]
    for name in ("kpi_total_sales_by_store", "kpi_monthly_sales_trend"):
        assert QUERIES[name](inputs).agg(F.sum("total_sales")).first()[0] == pytest.approx(total)


def _errors(spark, errors, copies=None):
    rows = [(1, 1, 2010, 2, float(e), c) for e, c in zip(errors, copies or [1] * len(errors))]
    return spark.createDataFrame(
        rows, "store int, dept int, year int, month int, prediction_error_percentage double, copies bigint"
    )


def test_accuracy_bands_are_nested(spark):
    row = star.kpi_prediction_accuracy(_errors(spark, [5, -10, 20, 20.01])).first()
    assert (row["excellent_predictions"], row["good_predictions"]) == (1, 2)
    assert (row["fair_predictions"], row["poor_predictions"]) == (3, 1)
    assert row["total_predictions"] == 4


def test_single_error_has_no_deviation(spark):
    assert star.kpi_prediction_accuracy(_errors(spark, [5])).first()["stddev_error_percentage"] is None


def test_literal_accuracy_equals_written_out_copies(spark):
    """Q1 for the accuracy KPI: weights give what repeated rows would give."""
    weighted = star.kpi_prediction_accuracy(_errors(spark, [1, 4, 30], [3, 1, 2]), literal=True).first()
    written = star.kpi_prediction_accuracy(_errors(spark, [1, 1, 1, 4, 30, 30])).first()
    assert weighted.asDict() == pytest.approx(written.asDict())


def test_accuracy_totals(inputs):
    table = QUERIES["kpi_prediction_accuracy"](inputs)
    bad = table.filter(
        "excellent_predictions > good_predictions or good_predictions > fair_predictions"
        " or fair_predictions + poor_predictions <> total_predictions"
    )
    assert table.count() > 0 and bad.count() == 0


def test_weekend_flag(spark):
    days = [(dt.date(2010, 2, d),) for d in range(1, 8)]  # Monday to Sunday
    rows = star.dim_date(spark.createDataFrame(days, "date date")).orderBy("date").collect()
    assert [r["is_weekend"] for r in rows] == [0, 0, 0, 0, 0, 1, 1]
    assert [r["day_of_week"] for r in rows] == [2, 3, 4, 5, 6, 7, 1]


def test_quality_checks_report_failures(spark):
    ids = spark.range(1).select(F.lit(1).alias("id")).unionByName(
        spark.range(1).select(F.lit(None).cast("int").alias("id"))
    )
    assert [r["failures"] for r in quality.not_null(ids, "ids", ["id"]).collect()] == [1]
    assert [r["failures"] for r in quality.unique(ids, "ids", ["id"]).collect()] == [0]
    assert [r["id"] for r in ids.filter(F.col("id") == 1).collect()] == [1]
    twice = ids.unionByName(ids)
    assert quality.unique(twice, "ids", ["id"]).first()["failures"] == 1
    keyed = [("ids", ["id"], ids), ("twice", ["id"], twice), ("none", ["id"], ids.limit(0))]
    assert [tuple(r) for r in quality.unique_keys(keyed).collect()] == [
        ("ids", "id", 0), ("twice", "id", 1), ("none", "id", 0)
    ]


def test_unique_keys_compares_numbers_and_days_without_text(spark):
    days = spark.createDataFrame(
        [(1, 2, dt.date(2010, 2, 5)), (2, 1, dt.date(2010, 2, 5)), (1, 2, dt.date(2010, 2, 5)), (1, None, None)],
        "store int, dept bigint, date date",
    )
    texts = spark.createDataFrame(
        [("a", 1, 0.5), ("a", 1, 0.5), ("a", 2, 0.5), ("1", 1, 0.5), ("a", 1, 1.5)], "t string, n int, x double"
    )
    checks = [("days", ["store", "dept", "date"], days), ("stores", ["store"], days), ("texts", ["n", "t", "x"], texts)]
    found = quality.unique_keys(checks)
    assert [r["failures"] for r in found.collect()] == [1, 1, 1]
    numbers = quality.unique_keys(checks[:2])._jdf.queryExecution().executedPlan().toString()
    assert "to_json" not in numbers.lower() and "structstojson" not in numbers.lower()


def test_top_departments_keep_ties(spark):
    rows = [(1, d, v) for d, v in enumerate([5.0, 4.0, 4.0, 4.0, 1.0], start=1)]
    sales = spark.createDataFrame(rows, "store int, dept int, actual_weekly_sales double")
    assert sorted(r["dept"] for r in reports.top_departments(sales, k=2).collect()) == [1, 2, 3, 4]


def test_percent_change_of_an_empty_month_is_null(spark):
    trend = spark.createDataFrame([(2010, 1, 0.0), (2010, 2, 5.0), (2010, 3, 10.0)],
                                  "year int, month int, total_sales double")
    rows = reports.monthly_pct_change(trend).orderBy("month").collect()
    assert [r["pct_change"] for r in rows] == [None, None, 100.0]
