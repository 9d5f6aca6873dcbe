"""One store and week holds a third of the raw rows, and nothing may be broadcast."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import cleaning, quality
from shelfcast.plans import features, star

HOT = dt.date(2010, 2, 5)
N = 60_000


@pytest.fixture(scope="module")
def shuffled(spark):
    """Small thresholds stand for large data: joins shuffle, skewed partitions split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
        "spark.sql.files.maxPartitionBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.fixture(scope="module")
def raw(shuffled, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skew"))
    i = F.col("id")
    hot = i % 3 == 0
    shuffled.range(0, N, 1, 8).select(
        F.when(hot, 1).otherwise(i % 97 + 1).cast("int").alias("store"),
        F.when(hot, 1).otherwise(i % 5 + 1).cast("int").alias("dept"),
        F.when(hot, F.lit(HOT)).otherwise(F.date_add(F.lit(HOT), (i % 150).cast("int") * 7)).alias("date"),
        (F.hash("id") % 1000).cast("double").alias("weekly_sales"),
        F.when(i % 7 == 0, "TRUE").otherwise("FALSE").alias("isholiday"),
    ).write.parquet(f"{folder}/sales")
    stores = shuffled.range(1, 98).select(
        F.col("id").cast("int").alias("store"), F.lit("A").alias("type"), F.lit(10).alias("size")
    )
    weeks = shuffled.range(150).select(F.date_add(F.lit(HOT), F.col("id").cast("int") * 7).alias("date"))
    conditions = [(F.col("store") * 1.0).alias(c) for c in star.CONDITIONS]
    stores.join(weeks).select("store", "date", *conditions).write.parquet(f"{folder}/features")
    stores.write.parquet(f"{folder}/stores")
    return tuple(shuffled.read.parquet(f"{folder}/{n}") for n in ("sales", "features", "stores"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_a_hot_store_and_week_is_split_and_kept_whole(raw):
    sales, conditions, stores = raw
    joined = features.enrich_sales(sales, conditions, stores)
    plan = final_plan(joined)
    assert "SortMergeJoin(skew=true)" in plan and "BroadcastHashJoin" not in plan
    got = joined.agg(F.count("*"), F.sum("weekly_sales"), F.count("cpi")).first()
    expected = sales.agg(F.count("*"), F.sum("weekly_sales")).first()
    assert tuple(got) == (expected[0], expected[1], expected[0])


def test_hot_key_reaches_the_shuffle_as_few_rows(raw):
    """Copies of a key collapse where they are read: one row per task and key at most."""
    sales, *_ = raw
    staged = star.stg_sales(sales)
    assert staged.count() == sales.select(*cleaning.SALES_KEY).distinct().count()
    plan = final_plan(staged)
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_max")
    assert "Window" not in plan
    repeated = quality.unique(sales, "sales", cleaning.SALES_KEY).first()["failures"]
    assert repeated == sales.groupBy(*cleaning.SALES_KEY).count().filter("count > 1").count()


def test_fact_without_broadcast_equals_the_fact_with_it(raw, spark):
    sales, conditions, stores = raw
    predictions = star.stg_sales(sales).select(
        *cleaning.SALES_KEY, (F.col("weekly_sales") * 1.1).alias("predicted_weekly_sales")
    )

    def build():
        return star.fct_sales_analytics(
            star.stg_sales(sales), star.stg_features(conditions), star.stg_stores(stores), predictions
        ).agg(
            F.count("*"), F.sum("actual_weekly_sales"), F.sum("prediction_error_absolute"),
            F.sum("cpi"), F.sum("store_size"),
        ).first()

    shuffled = build()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    spread = build()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert tuple(shuffled) == pytest.approx(tuple(spread))
