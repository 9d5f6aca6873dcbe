import datetime as dt

import pytest
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from shelfcast.functions.columns import exact_sum, holiday_flag, parse_mixed_date, week_friday
from shelfcast.operators import cleaning, scaling
from shelfcast.plans.features import total_markdown

DAY = dt.date(2010, 2, 5)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_dedup_keeps_the_highest_sale_and_its_flag(spark):
    rows = [(1, 1, DAY, 10.0, 0), (1, 1, DAY, 7.0, 1), (1, 2, DAY, 5.0, 0), (1, 2, DAY, 5.0, 1)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, isholiday int")
    kept = cleaning.highest_sale_per_key(df).orderBy("dept")
    assert values(kept, "dept", "weekly_sales", "isholiday") == [(1, 10.0, 0), (2, 5.0, 1)]


def test_dedup_combines_copies_before_the_shuffle(spark):
    """A key with very many copies must not reach one task as rows."""
    df = spark.range(1000).select(
        F.lit(1).alias("store"), F.lit(1).alias("dept"), F.lit(DAY).alias("date"),
        F.col("id").cast("double").alias("weekly_sales"), F.lit(0).alias("isholiday"),
    )
    kept = cleaning.highest_sale_per_key(df)
    assert values(kept, "weekly_sales") == [(999.0,)]
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "partial_max" in plan and "Window" not in plan and "SortAggregate" not in plan


def test_null_rows_are_dropped(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 1.0), (3, None)], "a int, b double")
    assert values(cleaning.keep_complete(df, ["a", "b"]), "a") == [(1,)]


@pytest.mark.parametrize(
    "text, flag",
    [("true", 1), ("TRUE", 1), ("1", 1), ("Y", 1), ("y", 1), ("FALSE", 0), ("0", 0), ("N", 0), (None, 0)],
)
def test_holiday_text(spark, text, flag):
    df = spark.createDataFrame([(text,)], "h string")
    assert df.select(holiday_flag("h")).first()[0] == flag


def test_ingest_accepts_only_true(spark):
    df = spark.createDataFrame([("Y",), ("true",)], "h string")
    assert [r[0] for r in df.select(holiday_flag("h", ("TRUE",))).collect()] == [0, 1]


@pytest.mark.parametrize(
    "text, day",
    [
        ("05/02/2010", dt.date(2010, 2, 5)),
        ("02/13/2012", dt.date(2012, 2, 13)),
        (" 2010-02-05 ", dt.date(2010, 2, 5)),
        ("x", None),
        (None, None),
    ],
)
def test_dates_are_day_first_and_never_raise(spark, text, day):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(parse_mixed_date("d")).first()[0] == day


def test_markdown_text_counts_as_zero_and_missing_columns_are_ignored(spark):
    df = spark.createDataFrame([("1.5", "NA", None)], "markdown1 string, markdown2 string, markdown4 string")
    assert total_markdown(df).first()["total_markdown"] == 1.5
    none = spark.createDataFrame([(1,)], "store int")
    assert total_markdown(none).first()["total_markdown"] == 0.0


def test_fill_by_type(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None)], "t string, i int, b bigint, d double, keep double"
    )
    filled = cleaning.fill_by_type(df, keep=("keep",)).first()
    assert tuple(filled) == ("Unknown", 0, 0, 0.0, None)


def test_imputation_uses_the_training_mean(spark):
    df = spark.createDataFrame(
        [(dt.date(2010, 1, 1), 2.0, None), (dt.date(2010, 1, 8), 4.0, 1.0), (dt.date(2011, 1, 7), None, 9.0)],
        "date date, size double, lag double",
    )
    train = cleaning.before(df, "2011-01-01")
    filled = cleaning.impute(df, zero=["lag"], mean=["size"], training=train).orderBy("date")
    assert values(filled, "size", "lag") == [(2.0, 0.0), (4.0, 1.0), (3.0, 9.0)]


def test_date_filters(spark):
    days = [dt.date(2010, 1, d) for d in (1, 8, 15)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    assert cleaning.before(df, "2010-01-08").count() == 1
    assert cleaning.between_days(df, days[0], days[1]).count() == 2
    assert cleaning.trailing_months(df, dt.date(2012, 1, 8)).count() == 2


def test_hash_split_depends_on_the_key_only(spark):
    df = spark.range(2000).select(F.col("id").alias("k"))
    split = cleaning.hash_split(df, ["k"], 80, seed=42)
    again = cleaning.hash_split(df.repartition(13).filter("k % 2 = 0"), ["k"], 80, seed=42)
    share = split.filter("split = 'train'").count() / 2000
    assert 0.77 < share < 0.83
    assert again.exceptAll(split).count() == 0
    other = cleaning.hash_split(df, ["k"], 80, seed=7)
    assert other.exceptAll(split).count() > 0


def test_standardize_agrees_with_the_ml_scaler(spark):
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(10)], "a double, b double")
    scaled = scaling.standardize(df, ["a", "b", "absent"])
    vector = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    scaler = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vector)
    expected = scaling.vector_columns(scaler.transform(vector), "s", ["sa", "sb"])
    got = values(scaled.orderBy("a"), "a_scaled", "b_scaled")
    for x, y in zip(got, values(expected.orderBy("a"), "sa", "sb")):
        assert x == pytest.approx(y)


def test_standardize_constant_and_missing_values(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, None), (5.0, 3.0)], "c double, x double")
    rows = values(scaling.standardize(df, ["c", "x"]), "c_scaled", "x_scaled")
    assert [r[0] for r in rows] == [0.0, 0.0, 0.0]
    assert rows[1][1] is None and rows[0][1] == pytest.approx(-(2**-0.5))


def test_exact_sum_and_week(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(-0.3,)], "x double")
    assert df.agg(exact_sum("x")).first()[0] == 0.7
    days = [dt.date(2010, 2, d) for d in range(1, 9)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select(week_friday("d"))
    assert [r[0].day for r in rows.collect()] == [5] * 7 + [12]


def test_one_row_per_key_keeps_a_real_row(spark):
    df = spark.createDataFrame([(1, 1, 9, 1, 9), (1, 1, 1, 9, 1)], "store int, date int, a int, b int, c int")
    assert [tuple(r) for r in cleaning.one_row_per_key(df, ["store", "date"]).collect()] == [(1, 1, 9, 1, 9)]


def test_a_year_column_decides_nothing_about_dates(spark):
    rows = [(dt.date(2000, 1, 1), y) for y in (2000, 2005, None)]
    df = spark.createDataFrame(rows, "date date, year int")
    assert cleaning.before(df, "2001-01-05").count() == 3
    assert cleaning.between_days(df, "1999-01-01", "2001-01-05").count() == 3
