"""Piecewise-linear trend with Fourier seasons (after Taylor and Letham, 2018).

A series is a line whose slope may change at evenly spread changepoints, plus (or times) a
season of sines and cosines. All coefficients have normal priors, so a fit is one system of
penalised normal equations: narrow priors on the slope changes keep those that the data do
not call for near zero. The noise that the penalties are measured against is estimated from
the residuals. Series of one length share their basis; numpy solves all of a batch together.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# functions that run in tasks travel by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Usual settings of this model.
CHANGEPOINTS, RANGE, PRIOR, SEASON_PRIOR, LINE_PRIOR = 25, 0.8, 0.05, 10.0, 5.0
WEEK, WEEK_ORDER = 7.0, 3
YEAR, YEAR_ORDER = 365.25, 10
LEAST_NOISE = 0.01  # of the largest value
ROUNDS = 4  # of noise estimates; for seasons as factors also of trend and season in turn


def changepoint_places(n: int, changepoints: int, share: float) -> np.ndarray:
    """Days (from 0) at which the slope may change, within the first ``share`` of n days."""
    last = int(np.floor(n * share)) - 1
    number = max(0, min(changepoints, last))
    return np.round(np.linspace(0, max(last, 0), number + 1)).astype(int)[1:]


def trend_basis(day: np.ndarray, n: int, places: np.ndarray, growth: str) -> np.ndarray:
    """Columns 1, t and (t - s)+ of the given days; t runs from 0 to 1 over the history."""
    ones = np.ones((len(day), 1))
    if growth == "flat":
        return ones
    t, s = day / max(n - 1, 1), places / max(n - 1, 1)
    return np.column_stack([ones, t, np.maximum(t[:, None] - s, 0.0)])


def season_basis(day: np.ndarray, freq_days: int, weekly: int, yearly: int) -> np.ndarray:
    """Sines and cosines of the week and the year, up to the given orders."""
    columns = [
        wave(2 * np.pi * k * day * freq_days / period)
        for period, order in ((WEEK, weekly), (YEAR, yearly))
        for k in range(1, order + 1)
        for wave in (np.sin, np.cos)
    ]
    return np.column_stack(columns) if columns else np.zeros((len(day), 0))


def _solve(gram: np.ndarray, moment: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Coefficients of every series from its normal equations, by Cholesky."""
    matrix = gram + penalty[:, :, None] * np.eye(gram.shape[-1])
    root = np.linalg.cholesky(matrix)
    half = np.linalg.solve(root, moment[:, :, None])
    return np.linalg.solve(np.swapaxes(root, 1, 2), half)[:, :, 0]


def fit_length(
    y: np.ndarray, steps: int, growth: str, changepoints: int, share: float, prior: float, mode: str,
    season_prior: float, weekly: int, yearly: int, freq_days: int, noise: float | None,
) -> np.ndarray:
    """Forecasts (series, steps) of series (series, days) of one length."""
    m, n = y.shape
    places = changepoint_places(n, changepoints, share)
    past, ahead = np.arange(n, dtype=float), np.arange(n, n + steps, dtype=float)
    trend, season = trend_basis(past, n, places, growth), season_basis(past, freq_days, weekly, yearly)
    trend_on, season_on = trend_basis(ahead, n, places, growth), season_basis(ahead, freq_days, weekly, yearly)
    size = np.abs(y).max(axis=1)
    size[size == 0] = 1.0
    z = y / size[:, None]
    p = trend.shape[1]
    line = min(p, 2)
    width = np.concatenate([np.full(line, LINE_PRIOR), np.full(p - line, prior), np.full(season.shape[1], season_prior)])
    sigma = np.full(m, 0.1 if noise is None else noise)
    rounds = ROUNDS if noise is None or mode == "multiplicative" else 1

    def penalty(columns: slice) -> np.ndarray:
        return (sigma[:, None] / width[columns]) ** 2

    factor = np.zeros((m, season.shape[1]))
    basis = np.hstack([trend, season])
    for _ in range(rounds):
        if mode == "additive":
            gram = np.broadcast_to(basis.T @ basis, (m, basis.shape[1], basis.shape[1]))
            found = _solve(gram, z @ basis, penalty(slice(None)))
            fitted = found @ basis.T
            path = found @ np.hstack([trend_on, season_on]).T
        else:
            lift = 1.0 + factor @ season.T
            own = lift[:, :, None] * trend
            found = _solve(np.swapaxes(own, 1, 2) @ own, np.einsum("mnp,mn->mp", own, z), penalty(slice(0, p)))
            level = found @ trend.T
            if season.shape[1]:
                own = level[:, :, None] * season
                factor = _solve(np.swapaxes(own, 1, 2) @ own, np.einsum("mnp,mn->mp", own, z - level), penalty(slice(p, None)))
            fitted = level * (1.0 + factor @ season.T)
            path = (found @ trend_on.T) * (1.0 + factor @ season_on.T)
        if noise is None:
            sigma = np.maximum(np.sqrt(((z - fitted) ** 2).mean(axis=1)), LEAST_NOISE)
    return path * size[:, None]


def changepoint_trend(
    y: Column,
    steps: int,
    growth: str = "linear",
    changepoints: int = CHANGEPOINTS,
    changepoint_range: float = RANGE,
    changepoint_prior: float = PRIOR,
    mode: str = "additive",
    season_prior: float = SEASON_PRIOR,
    weekly: bool | int | str = "auto",
    yearly: bool | int | str = "auto",
    freq_days: int = 1,
    noise: float | None = None,
) -> Column:
    """Forecast by trend and season. ``weekly`` and ``yearly`` are an order, on, off, or "auto":
    on with two periods of history. ``noise``, as a share of the largest value, is estimated
    unless given. A history that is null or holds null or non-finite values gives null.
    """
    if growth not in ("linear", "flat"):
        raise ValueError(f"unknown growth {growth!r}: use 'linear' or 'flat'")
    if mode not in ("additive", "multiplicative"):
        raise ValueError(f"unknown seasonality mode {mode!r}: use 'additive' or 'multiplicative'")
    if changepoints < 0 or not 0 < changepoint_range <= 1 or min(changepoint_prior, season_prior) <= 0:
        raise ValueError("changepoints must be 0 or more, their range in (0, 1], priors above 0")

    def order(asked: bool | int | str, usual: int, period: float, n: int) -> int:
        if asked == "auto":
            return usual if n * freq_days >= 2 * period else 0
        return usual * asked if isinstance(asked, bool) else int(asked)

    def forecast(batch: pd.Series) -> pd.Series:
        rows = [None if v is None else np.asarray(v, float) for v in batch]
        by_length: dict[int, list[int]] = {}
        for i, row in enumerate(rows):
            if row is not None and len(row) and np.isfinite(row).all():
                by_length.setdefault(len(row), []).append(i)
        paths = [None] * len(rows)
        for n, members in by_length.items():
            weeks, years = order(weekly, WEEK_ORDER, WEEK, n), order(yearly, YEAR_ORDER, YEAR, n)
            # bounded memory: some hundred series of one length at once
            for start in range(0, len(members), 512):
                some = members[start : start + 512]
                found = fit_length(
                    np.stack([rows[i] for i in some]), steps, growth, changepoints, changepoint_range,
                    changepoint_prior, mode, season_prior, weeks, years, freq_days, noise,
                )
                for i, path in zip(some, found):
                    paths[i] = path
        return pd.Series(paths, dtype=object)

    return F.pandas_udf(forecast, "array<double>")(y)
