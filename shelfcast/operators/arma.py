"""Least-squares ARMA for one regular weekly series, in numpy.

Two-step regression (Hannan and Rissanen, 1982): residuals of a long autoregression stand
in for the shocks, then the series is regressed on its own lags and those residuals.
"""

from __future__ import annotations

import math
from itertools import product

import numpy as np

SEASON = 52
#: Values beyond the seasons that a seasonal model needs, about what its largest search has to fit.
SPARE = 30
# Order used when no searched order is stable.
FALLBACK_ORDER = (2, 1, 2)


def _lagged(x: np.ndarray, lag: int, start: int) -> np.ndarray:
    return x[start - lag : len(x) - lag]


def _solve(gram: np.ndarray, cross: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(gram, cross)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(gram, cross, rcond=None)[0]


def _shocks(w: np.ndarray, order: int) -> np.ndarray:
    """Residuals of a long autoregression, 0 where it has no full history."""
    rows = np.column_stack([_lagged(w, k, order) for k in range(1, order + 1)])
    weights, *_ = np.linalg.lstsq(rows, w[order:], rcond=None)
    shocks = np.zeros_like(w)
    shocks[order:] = w[order:] - rows @ weights
    return shocks


def _stable(ar: dict[int, float]) -> bool:
    if sum(abs(c) for c in ar.values()) < 0.999:
        return True
    companion = np.zeros((max(ar), max(ar)))
    companion[0, [lag - 1 for lag in ar]] = list(ar.values())
    companion[1:, :-1] += np.eye(max(ar) - 1)
    return bool(np.max(np.abs(np.linalg.eigvals(companion))) < 0.999)


def _search(w: np.ndarray, ar_sets: list, ma_sets: list):
    """Stable lag sets with the lowest corrected AIC: (ar weights, ma weights, shocks)."""
    longest = max((max(s, default=0) for s in [*ar_sets, *ma_sets]), default=0)
    order = min(max(4, math.ceil(math.log(len(w)) * 2)), len(w) // 4)
    start = max(longest, order)
    n = len(w) - start
    if order < 1 or n < 10:
        return None
    shocks = _shocks(w, order)
    lags = [("ar", k) for k in sorted(set().union(*ar_sets))]
    lags += [("ma", k) for k in sorted(set().union(*ma_sets))]
    design = np.column_stack(
        [_lagged(w if kind == "ar" else shocks, k, start) for kind, k in lags] or [np.zeros(n)]
    )
    target = w[start:]
    gram, cross, total = design.T @ design, design.T @ target, float(target @ target)
    place = {lag: i for i, lag in enumerate(lags)}
    found = []
    for ar, ma in product(ar_sets, ma_sets):
        at = [place["ar", k] for k in ar] + [place["ma", k] for k in ma]
        k = len(at) + 1
        if n - k - 1 <= 0:
            continue
        part = gram[at][:, at]
        weights = _solve(part, cross[at]) if at else np.zeros(0)
        # The squares these very weights leave, also where the system is nearly singular.
        left = total - 2 * float(weights @ cross[at]) + float(weights @ part @ weights)
        squares = max(left, 1e-12 * max(total, 1.0))
        score = n * math.log(squares / n) + 2 * k + 2 * k * (k + 1) / (n - k - 1)
        found.append((score, len(found), ar, ma, weights))
    for _, _, ar_lags, ma_lags, weights in sorted(found, key=lambda f: f[:2]):
        ar = dict(zip(ar_lags, weights.tolist()))
        ma = dict(zip(ma_lags, weights[len(ar_lags) :].tolist()))
        if _stable(ar):
            return ar, ma, shocks
    return None


def _extend(w: np.ndarray, shocks: np.ndarray, ar: dict, ma: dict, horizon: int) -> np.ndarray:
    values, noise = w.tolist(), shocks.tolist() + [0.0] * horizon
    for _ in range(horizon):
        t = len(values)
        values.append(
            sum(c * values[t - k] for k, c in ar.items())
            + sum(c * noise[t - k] for k, c in ma.items())
        )
    return np.array(values[len(w) :])


def _undo(history: np.ndarray, future: np.ndarray, lag: int) -> np.ndarray:
    values = history.tolist()
    for step in future.tolist():
        values.append(values[-lag] + step)
    return np.array(values[len(history) :])


def forecast(
    y: np.ndarray,
    horizon: int,
    max_p: int = 2,
    max_d: int = 1,
    max_q: int = 2,
    season: int = SEASON,
    spare: int = SPARE,
) -> np.ndarray:
    """Next values of a series.

    A difference (seasonal, then weekly) is taken where it lowers the variance. A seasonal
    difference needs two full seasons and ``spare`` values, seasonal terms one season and
    ``spare`` values after differencing, as the search fits on what the lags leave. Shorter
    series are fitted without a season. Without a stable order the fallback order is tried,
    then a straight line through the ends.
    """
    y = np.asarray(y, dtype=float)
    if np.ptp(y) == 0:
        return np.full(horizon, y[-1])
    stages = [y]
    seasonal = len(y) >= 2 * season + spare
    taken = []
    for lag, allowed in ((season, seasonal), (1, max_d > 0)):
        differenced = stages[-1][lag:] - stages[-1][:-lag] if allowed else None
        if differenced is not None and np.var(differenced) < np.var(stages[-1]):
            stages.append(differenced)
            taken.append(lag)
    extra = [(), (season,)] if seasonal and len(stages[-1]) >= season + spare else [()]
    ar_sets = [(*range(1, p + 1), *s) for p in range(max_p + 1) for s in extra]
    ma_sets = [(*range(1, q + 1), *s) for q in range(max_q + 1) for s in extra]
    fitted = _model(stages[-1], ar_sets, ma_sets, horizon)
    if fitted is None:
        p, d, q = FALLBACK_ORDER
        stages, taken = [y, np.diff(y, d)], [1]
        fitted = _model(stages[-1], [tuple(range(1, p + 1))], [tuple(range(1, q + 1))], horizon)
    if fitted is None:
        return y[-1] + (y[-1] - y[0]) / max(len(y) - 1, 1) * np.arange(1, horizon + 1)
    for history, lag in zip(reversed(stages[:-1]), reversed(taken)):
        fitted = _undo(history, fitted, lag)
    return fitted


def _model(w: np.ndarray, ar_sets: list, ma_sets: list, horizon: int) -> np.ndarray | None:
    mean = float(np.mean(w))
    found = _search(w - mean, ar_sets, ma_sets)
    if found is None:
        return None
    ar, ma, shocks = found
    return _extend(w - mean, shocks, ar, ma, horizon) + mean
