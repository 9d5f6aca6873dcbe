"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Each query writes its whole result to the ``noop`` sink. The model queries
share one stored feature table, which the first of them writes.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import QUERIES
from shelfcast.session import clear_scratch, local_session
from shelfcast.sources.fixtures import RetailInputs

HEADLINE = [
    "stg_sales",
    "fct_sales_analytics",
    "fct_sales_analytics_literal",
    "kpi_total_sales_by_store",
    "kpi_monthly_sales_trend",
    "kpi_prediction_accuracy",
    "actual_vs_predicted_trend",
    "top_departments",
    "dq_not_null",
    "retail_features",
    "impute_mean",
    "scaled_econ",
    "sales_lags",
    "future_frame",
    "weekly_gap_fill",
    "forecastable_series",
    "forecast_seasonal_naive",
    "forecast_ar1_diff",
    "forecast_accuracy_by_series",
    "forecast_by_series",
    "backtest_by_series",
    "predict_lr",
    "predict_rf",
    "predict_gbt",
    "model_selection",
    "forecast_direct",
    "forecast_recursive",
    "forecast_recursive_forest",
    "forecast_recursive_linear",
]


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    # One untimed query starts the JVM's code paths.
    QUERIES["dim_store"](RetailInputs(spark, folder)).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names or HEADLINE:
        began = time.perf_counter()
        frame = QUERIES[name](RetailInputs(spark, folder))
        frame.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(f"{seconds[name]:8.2f}s  {name}", file=sys.stderr, flush=True)
    clear_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
