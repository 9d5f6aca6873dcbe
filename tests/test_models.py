import datetime as dt
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from checks.queries import CUT, GRID
from shelfcast.plans import features, models
from shelfcast.session import ensure_checkpoint_dir, scratch, scratch_path, shared, stored_once


@pytest.fixture(scope="module")
def table(inputs):
    return stored_once(features.retail_features(inputs.sales(), inputs.features(), inputs.stores()))


@pytest.fixture(scope="module")
def fitted(table):
    return models.fit(["linear_regression", "random_forest"], table, CUT)


def test_feature_table_has_one_row_per_key_and_no_nulls(table):
    keys = table.select("store", "dept", "date")
    assert keys.count() == keys.distinct().count()
    nulls = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in table.columns]).first()
    assert not any(nulls)
    scaled = table.agg(F.avg("cpi_scaled"), F.count("*")).first()
    assert abs(scaled[0]) < 1e-9


def test_models_beat_the_mean_and_selection_marks_one(table):
    """Sales that follow week and department: the derived orders are independent draws, in which
    there is nothing to learn."""
    signal = table.withColumn("weekly_sales", 100.0 * F.col("week") + 1000.0 * F.col("dept"))
    fitted = models.fit(["linear_regression", "random_forest"], signal, CUT)
    test = models.test_rows(signal, CUT)
    mean = signal.filter(F.col("date") < F.lit(CUT)).agg(F.avg("weekly_sales")).first()[0]
    plain = test.agg(F.sqrt(F.avg(F.pow(F.col("weekly_sales") - mean, 2)))).first()[0]
    rows = models.compare(fitted, test).collect()
    assert sum(r["is_best"] for r in rows) == 1
    best = min(rows, key=lambda r: r["rmse"])
    assert best["is_best"] == 1 and best["rmse"] < 0.5 * plain
    assert models.best_model(fitted, test) == best["model"]


def test_direct_forecast_covers_the_grid(table, fitted):
    forecast = models.forecast_direct(fitted["linear_regression"], table, *GRID)
    series = table.filter(F.col("date") < F.lit(CUT)).select("store", "dept").distinct().count()
    assert forecast.count() == series * 52
    assert forecast.filter("predicted_weekly_sales is null").count() == 0


@pytest.mark.parametrize("every", [2, 5])
def test_linear_recursion_equals_the_stepwise_one(table, fitted, every):
    """The single expression and the batches of steps are the same recursion."""
    filled, assembler, predictor = fitted["linear_regression"].stages
    start = models._start(filled, table, CUT)
    stepwise = models._batch_steps(PipelineModel([assembler, predictor]), start, 7, every)
    stepwise = stepwise.withColumnRenamed("predicted_weekly_sales", "p")
    single = models.forecast_recursive(fitted["linear_regression"], table, CUT, horizon=7)
    joined = single.join(stepwise, ["store", "dept", "date"], "full")
    off = F.abs(F.col("p") - F.col("predicted_weekly_sales"))
    worst, rows, nulls = joined.agg(F.max(off), F.count("*"), F.count_if(off.isNull())).first()
    assert rows == single.count() and nulls == 0 and worst < 1e-5


def test_recursive_tree_forecast_dates(table, fitted):
    forecast = models.forecast_recursive(fitted["random_forest"], table, CUT, horizon=6)
    per_series = forecast.groupBy("store", "dept").agg(
        F.count("*").alias("n"), F.countDistinct("date").alias("dates"),
        F.datediff(F.max("date"), F.min("date")).alias("days"),
    )
    assert {(r["n"], r["dates"], r["days"]) for r in per_series.collect()} == {(6, 6, 35)}


class _Echo:
    """Stands for a model that predicts the first lag."""

    def transform(self, df):
        return df.withColumn("prediction", F.col("weekly_sales_lag1"))


def test_identity_recursion_is_constant_and_starts_from_the_last_sales(spark, weekly):
    df = weekly({(1, 1): [1, 2, 3, 9], (1, 2): [4]})
    for name in models.HELD:
        df = df.withColumn(name, F.lit(1.0))
    from shelfcast.plans.baselines import recent_values

    state = recent_values(df, 4, also=models.HELD).withColumn("path", F.array().cast("array<double>"))
    rows = models._batch_steps(_Echo(), state, 5, 2).collect()
    assert len(rows) == 10
    assert {(r["dept"], r["predicted_weekly_sales"]) for r in rows} == {(1, 9.0), (2, 4.0)}


def test_recursion_shifts_lags_and_means_the_last_four(spark, weekly):
    class Probe:
        def transform(self, df):
            return df.withColumn(
                "prediction", F.col("weekly_sales_rolling4") + 10 * F.col("weekly_sales_lag3")
            )

    df = weekly({(1, 1): [1, 2, 3, 4, 5]})
    for name in models.HELD:
        df = df.withColumn(name, F.lit(1.0))
    from shelfcast.plans.baselines import recent_values

    state = recent_values(df, 4, also=models.HELD).withColumn("path", F.array().cast("array<double>"))
    got = [r["predicted_weekly_sales"] for r in models._batch_steps(Probe(), state, 4, 3).orderBy("date").collect()]
    y = [1.0, 2.0, 3.0, 4.0, 5.0]
    for _ in range(4):
        y.append(sum(y[-4:]) / 4 + 10 * y[-3])
    assert got == pytest.approx(y[5:])


def test_cross_validation_folds_move_forward(table):
    rows = models.cross_validate("linear_regression", table, dt.date(1997, 1, 3), folds=2).orderBy("fold").collect()
    assert [r["fold"] for r in rows] == [1, 2]
    assert rows[1]["cut"] - rows[0]["cut"] == dt.timedelta(weeks=13)
    assert all(r["rows"] > 0 and r["rmse"] > 0 for r in rows)


def test_training_never_sees_rows_after_the_cut(table):
    train = models.model_inputs(table.filter(F.col("date") < F.lit(CUT)))
    assert train.agg(F.max("date")).first()[0] < CUT
    assert models.test_rows(table, CUT).agg(F.min("date")).first()[0] >= CUT


def test_inputs_assemble_in_order(table):
    vector = VectorAssembler(inputCols=models.INPUTS, outputCol="inputs")
    row = vector.transform(models.model_inputs(table)).first()
    assert len(row["inputs"]) == 17 and row["inputs"][0] == row["store"]


def test_checkpoint_folder_comes_from_the_session(spark):
    current = spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == (current or spark.sparkContext.getCheckpointDir())


def test_regression_metrics(spark):
    scored = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double")
    row = models.regression_metrics(scored, "y", "p", []).first()
    assert row["rmse"] == pytest.approx((2 / 3) ** 0.5) and row["r2"] == pytest.approx(0.75)


def test_missing_sales_keep_their_week(spark):
    """Five weeks, the third without sales: the row stays and the lags stay in place."""
    days = [dt.date(2010, 1, 1) + dt.timedelta(weeks=i) for i in range(5)]
    sales = spark.createDataFrame(
        [(1, 1, d, None if i == 2 else float(i + 1), "FALSE") for i, d in enumerate(days)],
        "store int, dept int, date date, weekly_sales double, isholiday string",
    )
    given = [(1, d, 1.0 * i, 2.0, 3.0 + i, 4.0 + i) for i, d in enumerate(days)]
    conditions = spark.createDataFrame(
        given + given[:1],
        "store int, date date, temperature double, fuel_price double, cpi double, unemployment double",
    )
    stores = spark.createDataFrame([(1, "A", 10)], "store int, type string, size int")
    rows = features.retail_features(sales, conditions, stores).orderBy("date").collect()
    assert [r["weekly_sales"] for r in rows] == [1.0, 2.0, None, 4.0, 5.0]
    assert [r["weekly_sales_lag1"] for r in rows] == [0.0, 1.0, 2.0, 0.0, 4.0]
    assert rows[3]["weekly_sales_lag2"] == 2.0


def test_linear_model_is_least_squares(table, fitted):
    """The fitted line against numpy on the same rows."""
    filled, assembler, predictor = fitted["linear_regression"].stages
    ready = filled.transform(models.model_inputs(table.filter(F.col("date") < F.lit(CUT)))).toPandas()
    x = np.column_stack([ready[models.INPUTS].to_numpy(float), np.ones(len(ready))])
    y = ready["weekly_sales"].to_numpy(float)
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    line = x @ np.append(predictor.coefficients.toArray(), predictor.intercept)
    best = x @ beta
    assert ((y - line) ** 2).sum() <= ((y - best) ** 2).sum() * 1.001


def test_tree_recursion_equals_a_plain_loop(table, fitted):
    """Three series against a loop over the fitted forest, a week at a time."""
    filled, _, forest = fitted["random_forest"].stages
    horizon = 6
    forecast = models.forecast_recursive(fitted["random_forest"], table, CUT, horizon, every=4)
    state = models._start(filled, table, CUT).orderBy("store", "dept").limit(3).toPandas()
    for _, row in state.iterrows():
        recent, expected = list(row["recent"]), []
        for step in range(1, horizon + 1):
            day = row["last_date"] + dt.timedelta(weeks=step)
            lags = [recent[i] if i < len(recent) else 0.0 for i in range(3)]
            known = {
                "store": row["store"], "dept": row["dept"], **row[models.HELD],
                "week": day.isocalendar().week, "month": day.month, "year": day.year,
                "weekly_sales_lag1": lags[0], "weekly_sales_lag2": lags[1], "weekly_sales_lag3": lags[2],
                "weekly_sales_rolling4": sum(recent) / len(recent),
            }
            value = forest.predict(Vectors.dense([float(known[c]) for c in models.INPUTS]))
            expected.append((day, value))
            recent = [value, *recent][:4]
        of_series = (F.col("store") == int(row["store"])) & (F.col("dept") == int(row["dept"]))
        got = [(r["date"], r["predicted_weekly_sales"]) for r in forecast.filter(of_series).orderBy("date").collect()]
        assert [d for d, _ in got] == [d for d, _ in expected]
        assert [v for _, v in got] == pytest.approx([v for _, v in expected])


def test_comparison_equals_the_evaluator(table, fitted):
    """Both measures of both models against the library's evaluator, in one scan of the rows."""
    test = models.test_rows(table, CUT).filter("weekly_sales is not null")
    scores = models.compare(fitted, test)
    for row in scores.collect():
        scored = fitted[row["model"]].transform(test)
        for measure in ("rmse", "r2"):
            evaluator = RegressionEvaluator(labelCol="weekly_sales", metricName=measure)
            assert row[measure] == pytest.approx(evaluator.evaluate(scored))
    assert scores._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_stored_tables_are_shared_and_removed(spark, tmp_path):
    with scratch(spark):
        path = Path(scratch_path(spark).removeprefix("file:")).parent
        kept = stored_once(spark.range(5))
        assert kept.count() == 5 and path.is_dir()
    assert not path.exists()
    (tmp_path / "a").write_text("1")
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    for _ in range(2):
        assert shared("three", str(tmp_path), spark, make).count() == 3
    assert len(made) == 1
    (tmp_path / "b").write_text("22")
    shared("three", str(tmp_path), spark, make)
    assert len(made) == 2


def test_tasks_of_a_fit_hold_a_bounded_number_of_rows(spark, monkeypatch):
    from shelfcast import session

    monkeypatch.setattr(session, "FILE_ROWS", 100)
    monkeypatch.setattr(session, "TASK_BYTES", 1)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    with models.kept(spark.range(0, 1000, 1, 1)) as train:
        sizes = [len(part) for part in train.rdd.glom().collect()]
        assert sum(sizes) == 1000 and max(sizes) <= 100
        assert not train.storageLevel.useMemory
    assert spark.conf.get(key) == before
