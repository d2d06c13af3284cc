"""Holt-Winters smoothing (Winters, 1960) over batches of series.

Hundreds of parameter sets times sixty days are thousands of dependent steps per series, too
many for nested array folds, so numpy takes a whole Arrow batch of series through each step
together. Spark still places and moves the series.
"""

from __future__ import annotations

import itertools
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# functions that run in tasks travel by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Candidate smoothing parameters of the grid search.
ALPHAS = (0.1, 0.3, 0.6)
BETAS = (0.01, 0.1)
GAMMAS = (0.05, 0.2, 0.4)
GRID = tuple(itertools.product(ALPHAS, BETAS, GAMMAS))
DAMPING = 0.95

# Bounds of the continuous search: level, trend, season, damping.
LOW = np.array([0.001, 0.0001, 0.0001, 0.8])
HIGH = np.array([0.999, 0.999, 0.999, 0.98])
FIRST_STEP, LAST_STEP = 0.2, 0.004  # of the bounds' distance
BATCH = 2048  # series searched at once


class Smoother:
    """The recursion: which parts it has, and what it leaves behind."""

    def __init__(self, period: int, trend: bool, damped: bool, seasonal: str | None):
        self.period = period if seasonal else 1
        self.trend, self.damped = trend, trend and damped
        self.factor = seasonal == "multiplicative"
        # of (level, trend, season, damping), those that matter
        self.free = np.array([True, trend, bool(seasonal), self.damped])

    def run(self, y: np.ndarray, lengths: np.ndarray, params: np.ndarray):
        """(squared one-step error, level, trend, season) per series and parameter set.

        ``y`` is (series, days), ``params`` (series, sets, 4). The first period gives the level
        and the season, the first two the trend; smoothing runs from the second period on.
        """
        m = self.period
        alpha, beta, gamma, phi = np.moveaxis(params, 2, 0)
        first, second = (y[:, k : k + m].sum(axis=1) / m for k in (0, m))
        shape = alpha.shape
        level = np.broadcast_to(first[:, None], shape)
        trend = np.broadcast_to(((second - first) / m if self.trend else 0 * first)[:, None], shape)
        start = y[:, :m] / first[:, None] if self.factor else y[:, :m] - first[:, None]
        season = np.repeat(start[:, None, :], shape[1], axis=1)
        error = np.zeros(shape)
        for t in range(m, y.shape[1]):
            live = (t < lengths)[:, None]
            # a series that has ended keeps its state: nothing is missed any more
            carried = phi * trend
            base = np.where(live, level + carried, level)
            slot = season[:, :, t % m]
            if self.factor:
                miss = np.where(live, y[:, t, None] - base * slot, 0.0)
                new = np.where(live, base + alpha * miss / slot, level)
                season[:, :, t % m] = np.where(live, (1 - gamma) * slot + gamma * y[:, t, None] / new, slot)
                trend = np.where(live, carried + beta * (new - base), trend)
                level = new
            else:
                miss = np.where(live, y[:, t, None] - base - slot, 0.0)
                level = base + alpha * miss
                trend = np.where(live, carried, trend) + alpha * beta * miss
                season[:, :, t % m] = slot + gamma * (1.0 - alpha) * miss
            error = error + miss * miss
        return error, level, trend, season

    def ahead(self, state, lengths: np.ndarray, phi: np.ndarray, steps: int) -> np.ndarray:
        level, trend, season = (s[:, 0] for s in state)
        h = np.arange(1, steps + 1)
        grown = np.cumsum(phi[:, None] ** h, axis=1) if self.damped else np.broadcast_to(h, (len(phi), steps))
        line = level[:, None] + trend[:, None] * grown
        slots = season[np.arange(len(lengths))[:, None], (lengths[:, None] + h - 1) % self.period]
        return line * slots if self.factor else line + slots

    def grid(self) -> np.ndarray:
        """The candidate sets, parts that are not there left at neutral values."""
        sets = [(a, b if self.trend else 0.0, g if self.free[2] else 0.0) for a, b, g in GRID]
        return np.array([(*s, DAMPING if self.damped else 1.0) for s in dict.fromkeys(sets)])


def search(smoother: Smoother, y: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parameters, error) per series: the best of the grid, then steps along each parameter
    that are kept where they lower the error and halved where none does."""
    sets = smoother.grid()
    start = np.broadcast_to(sets, (len(y), *sets.shape))
    error = _error(smoother, y, lengths, start)
    each = np.arange(len(y))
    at, best = start[each, error.argmin(axis=1)].copy(), error.min(axis=1)
    free = np.flatnonzero(smoother.free)
    moves = np.concatenate([np.eye(4)[free], -np.eye(4)[free]]) * (HIGH - LOW)
    step = np.full(len(y), FIRST_STEP)
    low, high = np.where(smoother.free, LOW, -np.inf), np.where(smoother.free, HIGH, np.inf)
    while (todo := np.flatnonzero(step >= LAST_STEP)).size:
        tried = np.clip(at[todo, None] + step[todo, None, None] * moves, low, high)
        found = _error(smoother, y[todo], lengths[todo], tried)
        place = found.argmin(axis=1)
        least = found[np.arange(len(todo)), place]
        # by more than rounding, so that the search ends
        better = least < best[todo] * (1 - 1e-9)
        moved = todo[better]
        at[moved], best[moved] = tried[better, place[better]], least[better]
        step[todo[~better]] /= 2
    return at, best


def _error(smoother: Smoother, y, lengths, params) -> np.ndarray:
    with np.errstate(all="ignore"):
        error = smoother.run(y, lengths, params)[0]
    return np.where(np.isfinite(error), error, np.inf)


def _smoothed(batch: pd.Series, smoother: Smoother, given, fitted: bool):
    """(places in the batch, lengths, parameters, error, state) in parts of bounded size."""
    usable = [i for i, v in enumerate(batch) if v is not None and len(v) >= 2 * smoother.period]
    for begin in range(0, len(usable), BATCH):
        some = usable[begin : begin + BATCH]
        rows = [np.asarray(batch.iloc[i], float) for i in some]
        lengths = np.array([len(r) for r in rows])
        y = np.zeros((len(rows), lengths.max()))
        for row, values in zip(y, rows):
            row[: len(values)] = values
        if given is not None:
            params = np.broadcast_to(np.array(given), (len(rows), 4))
        elif fitted:
            params, _ = search(smoother, y, lengths)
        else:
            sets = smoother.grid()
            error = _error(smoother, y, lengths, np.broadcast_to(sets, (len(y), *sets.shape)))
            params = sets[error.argmin(axis=1)]
        with np.errstate(all="ignore"):
            error, *state = smoother.run(y, lengths, params[:, None, :])
        yield some, lengths, params, error[:, 0], state


def holt_winters(
    y: Column,
    steps: int,
    period: int = 7,
    alpha: float | None = None,
    beta: float | None = None,
    gamma: float | None = None,
    trend: str | None = "additive",
    damped: bool = False,
    seasonal: str | None = "additive",
    search: str = "fit",
) -> Column:
    """Forecast with level, trend and season; null below two periods of history.

    Smoothing parameters left out are chosen by the squared one-step error: ``fit`` searches
    them within bounds from the best of a small grid on, ``grid`` stays with the grid. A
    multiplicative season needs a history above 0, elsewhere the path is not finite.
    """
    smoother, given = _checked(period, alpha, beta, gamma, trend, damped, seasonal, search)

    def forecast(batch: pd.Series) -> pd.Series:
        paths = [None] * len(batch)
        for places, lengths, params, _, state in _smoothed(batch, smoother, given, search == "fit"):
            with np.errstate(all="ignore"):
                found = smoother.ahead(state, lengths, params[:, 3], steps)
            for i, path in zip(places, found):
                paths[i] = path
        return pd.Series(paths, dtype=object)

    return F.pandas_udf(forecast, "array<double>")(y)


def in_sample_error(y: Column, search: str = "fit", **parts) -> Column:
    """The squared one-step error that the chosen parameters leave; null for short series."""
    settings = {"period": 7, "alpha": None, "beta": None, "gamma": None, "trend": "additive", "damped": False, "seasonal": "additive"}
    smoother, given = _checked(**settings | parts, search=search)

    def measure(batch: pd.Series) -> pd.Series:
        errors = np.full(len(batch), np.nan)
        for places, _, _, error, _ in _smoothed(batch, smoother, given, search == "fit"):
            errors[places] = error
        return pd.Series(errors)

    return F.nanvl(F.pandas_udf(measure, "double")(y), F.lit(None))


def _checked(period, alpha, beta, gamma, trend, damped, seasonal, search):
    given = (alpha, beta, gamma)
    if any(p is None for p in given) and any(p is not None for p in given):
        raise ValueError("give all of alpha, beta and gamma, or none for the search")
    if trend not in (None, "additive") or seasonal not in (None, "additive", "multiplicative"):
        raise ValueError("trend is 'additive' or None, seasonal 'additive', 'multiplicative' or None")
    if search not in ("fit", "grid"):
        raise ValueError(f"unknown search {search!r}: use 'fit' or 'grid'")
    smoother = Smoother(period, trend is not None, damped, seasonal)
    if alpha is None:
        return smoother, None
    parts = (alpha, beta if smoother.trend else 0.0, gamma if seasonal else 0.0)
    return smoother, (*parts, DAMPING if smoother.damped else 1.0)
