"""The feature table built week by week equals the one built at once."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.scaling import merged_moments, moments, standardize, standardize_by
from shelfcast.plans import features, incremental, jobs

FIRST = dt.date(2010, 11, 5)
DAYS = [FIRST + dt.timedelta(weeks=i) for i in range(14)]
SALES = "store int, dept int, date date, weekly_sales double, isholiday string"
CONDITIONS = "store int, date date, fuel_price double, markdown1 double, markdown2 double, cpi double, unemployment double"


@pytest.fixture(scope="module")
def given(spark):
    """Gaps, repeated keys, null sales, a series that begins late and one that ends early."""
    rng = random.Random(23)
    sales, known = [], []
    for store in (1, 2, 3):
        for i, day in enumerate(DAYS):
            cpi = None if i == 5 else 200 + store + i / 7
            known.append((store, day, 2.5 + i / 10, float(i), None, cpi, 8.0 if store == 1 else None))
            for dept in (1, 2):
                if (store, dept) == (2, 2) and i < 8 or (store, dept) == (1, 2) and i > 4:
                    continue
                if rng.random() < 0.2:
                    continue
                amount = None if rng.random() < 0.1 else round(rng.uniform(10, 900), 2)
                sales += [(store, dept, day, amount, "TRUE" if i == 3 else "FALSE")] * rng.choice((1, 1, 2))
    known.append((1, DAYS[2], 9.9, 1.0, 1.0, 250.0, 9.0))
    sales += [(None, 1, DAYS[0], 5.0, "FALSE"), (1, 1, None, 5.0, "FALSE")]
    stores = spark.createDataFrame([(1, "A", 100), (2, None, 50)], "store int, type string, size int")
    return spark.createDataFrame(sales, SALES), spark.createDataFrame(known, CONDITIONS), stores


def rows(df):
    names = sorted(df.columns)
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr), names


def batches(sales, edges):
    for before, last in zip([None, *edges], edges, strict=False):
        inside = F.col("date") <= F.lit(last)
        yield last, sales.filter(inside if before is None else inside & (F.col("date") > F.lit(before)))


def test_runs_add_up_to_the_whole_table(spark, given, tmp_path):
    sales, known, stores = given
    layers = jobs.Layers(spark, str(tmp_path))
    for last, part in batches(sales, [DAYS[0], DAYS[1], DAYS[2], DAYS[6], DAYS[9], DAYS[13]]):
        incremental.extend(layers, part, known, stores, last)
    assert rows(incremental.feature_table(layers)) == rows(features.retail_features(*given))


def test_a_repeated_run_replaces_itself(spark, given, tmp_path, monkeypatch):
    sales, known, stores = given
    layers = jobs.Layers(spark, str(tmp_path))
    parts = list(batches(sales, [DAYS[4], DAYS[8], DAYS[13]]))
    incremental.extend(layers, parts[0][1], known, stores, parts[0][0])
    # The second run breaks off before its tails; it is run again, and the third one twice.
    whole = incremental.next_tails
    monkeypatch.setattr(incremental, "next_tails", lambda _: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        incremental.extend(layers, parts[1][1], known, stores, parts[1][0])
    monkeypatch.setattr(incremental, "next_tails", whole)
    for last, part in (parts[1], parts[2], parts[2]):
        incremental.extend(layers, part, known, stores, last)
    assert rows(incremental.feature_table(layers)) == rows(features.retail_features(*given))


def test_sales_outside_the_run_are_kept_aside(spark, given, tmp_path):
    sales, known, stores = given
    layers = jobs.Layers(spark, str(tmp_path))
    incremental.extend(layers, sales, known, stores, DAYS[4])
    incremental.extend(layers, sales, known, stores, DAYS[9])
    table = incremental.feature_table(layers)
    expected = features.retail_features(sales.filter(F.col("date") <= F.lit(DAYS[9])), known, stores)
    assert rows(table) == rows(expected)
    aside = layers.read("staging", "off_run_sales").withColumn("run", F.col("run").cast("string"))
    in_run = (F.col("date") > F.lit(DAYS[4])) & (F.col("date") <= F.lit(DAYS[9]))
    whole = sales.filter("store is not null and date is not null")
    assert aside.filter(F.col("run") == DAYS[9].isoformat()).count() == whole.filter(~in_run).count()


def test_runs_without_sales(spark, given, tmp_path):
    sales, known, stores = given
    layers = jobs.Layers(spark, str(tmp_path))
    none = sales.limit(0)
    assert incremental.extend(layers, none, known, stores, FIRST - dt.timedelta(weeks=1)).count() == 0
    for last, part in batches(sales, [DAYS[5], DAYS[13]]):
        incremental.extend(layers, part, known, stores, last)
        assert incremental.extend(layers, none, known, stores, last + dt.timedelta(days=1)).count() == 0
    assert rows(incremental.feature_table(layers)) == rows(features.retail_features(*given))


def test_a_run_reads_one_partition_of_the_tails_and_no_rows(spark, given, tmp_path):
    sales, known, stores = given
    layers = jobs.Layers(spark, str(tmp_path))
    for last, part in batches(sales, [DAYS[4], DAYS[8]]):
        incremental.extend(layers, part, known, stores, last)
    tails = layers.read("staging", "series_tails").filter(incremental._named(DAYS[8]))
    inside, _ = incremental.cut_to_run(sales, DAYS[8], DAYS[13])
    made = incremental.new_features(incremental.with_tails(inside, tails), known, stores)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "feature_rows" not in plan
    assert DAYS[8].isoformat() in plan.split("PartitionFilters: ", 1)[1].split("]")[0]
    # At most four rows of a series are carried on, whatever its length.
    assert tails.groupBy("store", "dept").count().agg(F.max("count")).first()[0] == 4


def test_moments_merge_like_one_pass(spark):
    rng = random.Random(29)
    values = [(i % 7, None if rng.random() < 0.1 else 1e6 + rng.gauss(0, 1e-2), 5.0, None) for i in range(700)]
    df = spark.createDataFrame(values, "part int, a double, b double, c double")
    parts = [moments(df.filter(F.col("part") == i), ["a", "b", "c"]) for i in range(7)]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    merged = {r["column"]: r for r in merged_moments(joined).collect()}
    known = [v[1] for v in values if v[1] is not None]
    mean = math.fsum(known) / len(known)
    assert merged["a"]["n"] == len(known) and math.isclose(merged["a"]["mean"], mean, rel_tol=1e-14)
    assert math.isclose(merged["a"]["m2"], math.fsum((v - mean) ** 2 for v in known), rel_tol=1e-6)
    assert merged["b"]["m2"] == 0 and "c" not in merged
    once, stored = standardize(df, ["a", "b", "c"]), standardize_by(df, merged_moments(joined), ["a", "b", "c"])
    for x, y in zip(once.orderBy("part", "a").collect(), stored.orderBy("part", "a").collect(), strict=True):
        assert x["b_scaled"] == y["b_scaled"] == 0.0 and x["c_scaled"] is y["c_scaled"] is None
        assert x["a_scaled"] is y["a_scaled"] is None or abs(x["a_scaled"] - y["a_scaled"]) < 1e-5
