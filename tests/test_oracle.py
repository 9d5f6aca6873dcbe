"""Every query with SQL gives the same columns, types and values as DuckDB."""

import pytest

from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES
from tests.conftest import FOLDER


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result_as_sql(name, inputs, duck):
    assert difference(QUERIES[name](inputs), duck, ORACLE[name]) is None


def test_every_query_without_sql_fits_a_model():
    assert sorted(set(QUERIES) - set(ORACLE)) == [
        "backtest_by_series",
        "forecast_by_series",
        "forecast_direct",
        "forecast_recursive",
        "forecast_recursive_forest",
        "forecast_recursive_linear",
        "model_selection",
        "predict_gbt",
        "predict_rf",
    ]
    assert set(ORACLE) <= set(QUERIES)
