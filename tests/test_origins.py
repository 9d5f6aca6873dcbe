"""Errors by horizon against a plain loop over origins."""

import datetime as dt
import math

import numpy as np
import pytest

from shelfcast.operators.series import fill_weekly_gaps
from shelfcast.plans import origins
from shelfcast.plans.baselines import ar1_on_differences

FIRST = dt.date(2010, 2, 5)


def _line(differences):
    x, y = np.array(differences[:-1]), np.array(differences[1:])
    if len(x) < 1 or np.ptp(x) == 0:
        return None
    b = ((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum()
    return y.mean() - b * x.mean(), b


def _by_hand(values, filled, count, horizon):
    """(step, method) -> errors, stepping every forecast week by week."""
    errors = {}
    for origin in range(len(values)):
        if not horizon <= len(values) - 1 - origin < horizon + count:
            continue
        known = values[: origin + 1]
        differences = np.diff(known).tolist()
        line = _line(differences)
        level, d = known[-1], differences[-1] if differences else 0.0
        for h in range(1, horizon + 1):
            if line:
                d = line[0] + line[1] * d
                level += d
            at = origin + h
            season = values[at - 52] if at >= 52 else known[-1]
            if not filled[at]:
                for method, forecast in (("naive", known[-1]), ("seasonal_naive", season), ("ar1", level)):
                    errors.setdefault((h, method), []).append(values[at] - forecast)
    return errors


SERIES = {
    (1, 1): [100 + 10 * math.sin(i / 5) + i % 7 for i in range(90)],
    (1, 2): [50.0 + (i * 37 % 11) for i in range(20)],
    (2, 1): [7.0] * 40,
    (2, 2): [1.0, 2.0, 4.0],
    (3, 1): [None if i % 9 == 4 else 30 + (i * 53 % 17) for i in range(70)],
}


@pytest.mark.parametrize(("count", "horizon"), [(13, 13), (4, 6), (100, 2)])
def test_errors_equal_a_loop_over_origins(weekly, count, horizon):
    found = origins.errors_by_horizon(fill_weekly_gaps(weekly(SERIES)), count, horizon).collect()
    expected = {}
    for key, values in SERIES.items():
        filled = [v is None for v in values]
        level = [v for i, v in enumerate(values)]
        for i, v in enumerate(level):
            level[i] = level[i - 1] if v is None else v
        for (h, method), errors in _by_hand(level, filled, count, horizon).items():
            expected.setdefault((*key, h), {})[method] = errors
    assert {(r["store"], r["dept"], r["step"]) for r in found} == set(expected)
    for r in found:
        for method, errors in expected[r["store"], r["dept"], r["step"]].items():
            assert r["weeks"] == len(errors)
            assert r[f"rmse_{method}"] == pytest.approx(math.sqrt(np.mean(np.square(errors))), abs=1e-6)
            assert r[f"mae_{method}"] == pytest.approx(np.mean(np.abs(errors)), abs=1e-6)


def test_an_origin_knows_nothing_of_later_weeks(weekly):
    """The last origin's forecast is that of the series cut there."""
    values = SERIES[1, 1]
    last = origins.origins(fill_weekly_gaps(weekly({(1, 1): values})), count=1, horizon=5).first()
    assert last["origin"] == FIRST + dt.timedelta(weeks=len(values) - 6)
    cut = ar1_on_differences(weekly({(1, 1): values[:-5]}), horizon=5).orderBy("date").collect()
    errors = origins.errors_by_horizon(fill_weekly_gaps(weekly({(1, 1): values})), 1, 5).orderBy("step").collect()
    for e, c, actual in zip(errors, cut, values[-5:], strict=True):
        assert e["mae_ar1"] == pytest.approx(abs(actual - c["predicted_weekly_sales"]), abs=1e-9)


def test_one_shuffle_serves_all_origins(weekly, capsys):
    df = fill_weekly_gaps(weekly(SERIES))
    origins.errors_by_horizon(df).explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_empty_series_and_long_horizons(weekly):
    assert origins.errors_by_horizon(fill_weekly_gaps(weekly({}))).count() == 0
    with pytest.raises(ValueError, match="season"):
        origins.errors_by_horizon(weekly(SERIES), horizon=53)
