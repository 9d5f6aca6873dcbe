import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import columns
from shelfcast.operators.series import sales_lags
from shelfcast.plans import features, star
from shelfcast.sources import schemas, tables


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "stores.csv").write_text("Store,Type,Size\n1,A,1000\n2,B,500\n")
    (tmp_path / "features.csv").write_text(
        "Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,MarkDown5,"
        "CPI,Unemployment,IsHoliday\n"
        "1,05/02/2010,42.3,2.5,NA,10.5,NA,NA,1,211.1,8.1,FALSE\n"
        "1,2010-02-12,38.5,NA,NA,NA,NA,NA,NA,211.2,8.1,TRUE\n"
    )
    (tmp_path / "sales.csv").write_text(
        "Store,Dept,Date,Weekly_Sales,IsHoliday\n"
        "1,1,2010-02-05,100.5,FALSE\n1,1,12/02/2010,200,TRUE\n2,1,02/19/2010,NA,FALSE\n"
    )
    return tmp_path


def test_csv_types_and_missing_values(spark, folder):
    stores = tables.read_stores(spark, str(folder / "stores.csv"))
    assert stores.schema == schemas.RAW_STORES
    assert [tuple(r) for r in stores.collect()] == [(1, "A", 1000), (2, "B", 500)]
    rows = tables.read_features(spark, str(folder / "features.csv")).orderBy("date").collect()
    assert [r["date"] for r in rows] == [dt.date(2010, 2, 5), dt.date(2010, 2, 12)]
    assert rows[0]["markdown1"] is None and rows[0]["markdown2"] == 10.5 and rows[1]["fuel_price"] is None
    assert "isholiday" not in rows[0].asDict()


def test_a_header_that_does_not_match_is_an_error(spark, folder):
    (folder / "bad.csv").write_text("Type,Store,Size\nA,1,1000\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_stores(spark, str(folder / "bad.csv")).collect()


def test_dates_are_parsed_before_the_join(spark, folder):
    """Q8: the same day in two formats meets in the join."""
    table = features.retail_features(
        tables.read_sales(spark, str(folder / "sales.csv")),
        tables.read_features(spark, str(folder / "features.csv")),
        tables.read_stores(spark, str(folder / "stores.csv")),
    )
    rows = {r["date"]: r for r in table.collect()}
    assert rows[dt.date(2010, 2, 5)]["total_markdown"] == 11.5
    assert rows[dt.date(2010, 2, 12)]["temperature"] == 38.5
    assert rows[dt.date(2010, 2, 12)]["isholidayencoded"] == 1
    assert rows[dt.date(2010, 2, 12)]["weekly_sales_lag1"] == 100.5
    # The row without sales stays and is not filled; staging drops it.
    assert len(rows) == 3 and rows[dt.date(2010, 2, 19)]["weekly_sales"] is None
    assert star.stg_sales(table).count() == 2


def test_write_overwrites_appends_and_partitions(spark, tmp_path):
    target = str(tmp_path / "fact")
    df = spark.createDataFrame([(1, 2010), (2, 2010), (3, 2011)], "v int, year int")
    tables.write_table(df, target, partition_by=["year"])
    tables.write_table(df, target, partition_by=["year"])
    assert tables.read_table(spark, target).count() == 3
    assert (tmp_path / "fact" / "year=2010").is_dir()
    scan = tables.read_table(spark, target).filter("year = 2011")
    assert "PartitionFilters: [isnotnull(year" in scan._jdf.queryExecution().executedPlan().toString()
    evaluation = str(tmp_path / "evaluation")
    for _ in range(2):
        tables.append_table(df, evaluation)
    assert tables.read_table(spark, evaluation).count() == 6


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounds_prune_only_the_tables_own_partitions(spark, tmp_path):
    rows = [(dt.date(y, 6, 1), y, 1.0) for y in (2009, 2010, 2011)] + [(dt.date(2010, 1, 1), None, 2.0)]
    df = spark.createDataFrame(rows, "date date, year int, v double")
    by_year, plain = str(tmp_path / "by_year"), str(tmp_path / "plain")
    tables.write_table(df.filter("year is not null"), by_year, partition_by=["year"])
    tables.write_table(df, plain)
    assert tables.partition_columns(spark, by_year) == ["year"] and tables.partition_columns(spark, plain) == []
    kept = tables.read_table(spark, by_year, last="2010-12-31")
    assert sorted(r["year"] for r in kept.collect()) == [2009, 2010]
    assert "year" in _plan(kept).split("PartitionFilters")[1][:80]
    assert tables.read_table(spark, plain, "2010-01-01", "2010-12-31").count() == 2


def test_every_line_is_accepted_or_rejected(spark, folder):
    lines = (
        "Store,Dept,Date,Weekly_Sales,IsHoliday\n1,1,2010-02-05,100.5,FALSE\n1,1,12/02/2010,NA,TRUE\n"
        "1,1,2010-02-19,1x,FALSE\n1,one,2010-02-19,1,FALSE\n1,1,someday,1,FALSE\n,1,2010-02-19,1,FALSE\n"
        "1,1\n1,1,NA,1,FALSE\n"
    )
    (folder / "wrong.csv").write_text(lines)
    accepted, rejected = tables.read_lines(
        spark, str(folder / "wrong.csv"), schemas.RAW_SALES, ["store", "dept", "date"]
    )
    assert [r["weekly_sales"] for r in accepted.orderBy("date").collect()] == [100.5, None]
    assert sorted(map(tuple, rejected.collect())) == sorted([
        ("1,1,2010-02-19,1x,FALSE", tables.MALFORMED), ("1,one,2010-02-19,1,FALSE", tables.MALFORMED),
        ("1,1", tables.MALFORMED), ("1,1,someday,1,FALSE", tables.BAD_DATE),
        (",1,2010-02-19,1,FALSE", tables.NO_KEY), ("1,1,NA,1,FALSE", tables.NO_KEY),
    ])
    assert accepted.count() + rejected.count() == len(lines.splitlines()) - 1
    # Columns that a query leaves out are judged all the same.
    assert accepted.select("store").count() == 2
    (folder / "other.csv").write_text("Type,Store,Size\nA,1,1000\n")
    with pytest.raises(ValueError, match="header"):
        tables.read_lines(spark, str(folder / "other.csv"), schemas.RAW_STORES, ["store"])


@pytest.mark.parametrize("kind", ["path", "catalog"])
def test_a_repeated_run_replaces_its_own_rows(spark, tmp_path, kind):
    target = str(tmp_path / "runs") if kind == "path" else "runs_of_a_test"
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    tables.write_run(rows(1, 2), target, "a")
    tables.write_run(rows(3), target, "b")
    tables.write_run(rows(4, 5, 6), target, "a")
    held = lambda: sorted((r["run"], r["v"]) for r in tables.read_table(spark, target).collect())
    assert held() == [("a", 4), ("a", 5), ("a", 6), ("b", 3)]

    # A run that breaks off half way leaves what was there.
    breaks = rows(7, 8, 9).repartition(3, "v").select(
        F.when(F.col("v") == 9, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")).alias("v")
    )
    with pytest.raises(Exception, match="lost"):
        tables.write_run(breaks, target, "a")
    spark.catalog.clearCache()
    assert held() == [("a", 4), ("a", 5), ("a", 6), ("b", 3)]
    tables.write_run(rows(1).filter("v > 1"), target, "a")
    if kind == "catalog":
        spark.sql(f"refresh table {target}")
    assert held() == [("b", 3)]
    with pytest.raises(ValueError, match="run"):
        tables.write_run(rows(1), target, "a/b")
    if kind == "catalog":
        spark.sql(f"drop table {target}")


def test_series_table_needs_no_shuffle(spark):
    df = spark.range(500).select(
        (F.col("id") % 7).cast("int").alias("store"), (F.col("id") % 3).cast("int").alias("dept"),
        F.date_add(F.lit(dt.date(2010, 2, 5)), F.col("id").cast("int")).alias("date"),
        F.col("id").cast("double").alias("weekly_sales"),
    )
    tables.write_series_table(df, "series_table", buckets=4)
    lags = sales_lags(tables.read_table(spark, "series_table"))
    assert "Exchange" not in lags._jdf.queryExecution().executedPlan().toString()
    assert lags.count() == 500
    spark.sql("drop table series_table")


def test_week_bounds_reach_the_scan(inputs, capsys):
    bounded = inputs.sales_base(dt.date(1998, 1, 2), dt.date(1999, 1, 1))
    bounded.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    days = F.col("date").between(dt.date(1998, 1, 2), dt.date(1998, 12, 31))
    assert bounded.exceptAll(inputs.sales_base().filter(days)).count() == 0
    assert inputs.sales_base().filter(days).exceptAll(bounded).count() == 0


def test_view_and_row_count(spark, tmp_path):
    df = spark.range(7)
    tables.create_view(df, "seven")
    assert tables.read_table(spark, "seven").count() == 7
    counted, seen = tables.count_rows(df, "rows_written")
    tables.write_table(counted, str(tmp_path / "seven"))
    assert seen.get["rows"] == 7


def test_declared_sources():
    assert schemas.SOURCES["raw"]["stg_sales"].names == ["store", "dept", "date", "weekly_sales", "isholiday"]
    assert schemas.PREDICTIONS.names[-1] == "predicted_weekly_sales"


def test_a_line_and_its_date_are_parsed_once(spark):
    lines = spark.createDataFrame([("1,1,2010-02-05,5.0,TRUE",), ("1,1,12/25/2010,12x,TRUE",)], "value string")
    parsed = tables.parse_lines(lines, schemas.RAW_SALES, ["store", "dept", "date"])
    accepted = parsed.filter(F.col("reason").isNull()).drop("line", "reason")
    plan = accepted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1 or plan.lower().count("csvtostructs") == 1
    assert plan.count("rlike") + plan.count("RLIKE") == len(columns.DATE_FORMATS)


def test_only_formats_that_fit_are_tried_on_a_date(spark):
    texts = [
        "01/02/2020", "12/25/1995", "25/12/1995", " 2020-02-28 ", "2020-02-30", "1/2/2020", "13/13/2020", "00/01/2020",
        "-2020-01-02", "+20200-01-02", "20200-01-02", "01/02/+20200", "not a date", "", None, "31/02/2020", "02/31/2020",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    every = F.coalesce(*[F.try_to_date(F.trim("t"), fmt) for fmt in columns.DATE_FORMATS])
    tried = df.select(every.cast("string").alias("every"), columns.parse_mixed_date("t").cast("string").alias("got"))
    assert all(r["every"] == r["got"] for r in tried.collect())
