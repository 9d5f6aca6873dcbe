import datetime as dt

import pytest

from shelfcast.session import clear_scratch, local_session
from shelfcast.sources.fixtures import RetailInputs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    return RetailInputs(spark, FOLDER)


@pytest.fixture(scope="session")
def weekly(spark):
    """Builds regular Friday series: weekly({(store, dept): [values]}, first date)."""

    def build(series, first=dt.date(2010, 2, 5)):
        rows = [
            (store, dept, first + dt.timedelta(weeks=i), None if y is None else float(y))
            for (store, dept), values in series.items()
            for i, y in enumerate(values)
        ]
        return spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double")

    return build
