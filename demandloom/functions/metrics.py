"""Forecast error metrics as aggregate columns.

A metric is a function of (actual, predicted) columns that returns one aggregate
column. ``mape`` is a fraction, ``mape_pct``, ``wmape`` and ``smape`` are percentages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MetricColumn = Callable[[Column, Column], Column]


def _guarded(numerator: Column, denominator: Column) -> Column:
    """numerator/denominator where 0/0 is skipped and x/0 is infinite."""
    return (
        F.when(denominator != 0, numerator / denominator)
        .when(numerator != 0, F.lit(float("inf")))
    )


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def mse(y: Column, p: Column) -> Column:
    return F.avg((y - p) * (y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(mse(y, p))


def mape(epsilon: float = 0.0) -> MetricColumn:
    """Mean of |y - p| / (y + epsilon), a fraction."""

    def mape(y: Column, p: Column) -> Column:
        return F.avg(_guarded(F.abs(y - p), y + F.lit(float(epsilon))))

    return mape


def mape_pct(y: Column, p: Column) -> Column:
    return 100.0 * F.avg(_guarded(F.abs(y - p), F.abs(y)))


def wmape(y: Column, p: Column) -> Column:
    return 100.0 * _guarded(F.sum(F.abs(y - p)), F.sum(F.abs(y)))


def smape(y: Column, p: Column) -> Column:
    return 200.0 * F.avg(_guarded(F.abs(y - p), F.abs(y) + F.abs(p)))


def bias(y: Column, p: Column) -> Column:
    """Mean of predicted minus actual; positive when forecasting too much."""
    return F.avg(p - y)


def r2(y: Column, p: Column) -> Column:
    spread = F.var_pop(y) * F.count(y)
    return F.lit(1.0) - _guarded(F.sum((y - p) * (y - p)), spread)


def rmsle(y: Column, p: Column) -> Column:
    """Root mean squared log error; null when a value is -1 or less."""
    defined = F.min(F.least(y, p)) > -1.0
    gap = F.log1p(y) - F.log1p(p)
    return F.when(defined, F.sqrt(F.avg(gap * gap)))


def marre(y: Column, p: Column) -> Column:
    """Mean absolute error as a percentage of the actuals' range."""
    return 100.0 * _guarded(F.avg(F.abs(y - p)), F.max(y) - F.min(y))


def ope(y: Column, p: Column) -> Column:
    """Difference of the totals as a percentage of the actual total."""
    return 100.0 * F.abs(_guarded(F.sum(y) - F.sum(p), F.sum(y)))


def coefficient_of_variation(y: Column, p: Column) -> Column:
    """Root mean squared error as a percentage of the mean actual."""
    return 100.0 * _guarded(rmse(y, p), F.avg(y))


# name -> metric over (actual, predicted)
METRICS: dict[str, MetricColumn] = {
    "mae": mae,
    "mse": mse,
    "rmse": rmse,
    "mape": mape(),
    "mape_pct": mape_pct,
    "wmape": wmape,
    "smape": smape,
    "bias": bias,
    "r2": r2,
    "r2_score": r2,
    "rmsle": rmsle,
    "marre": marre,
    "ope": ope,
    "coefficient_of_variation": coefficient_of_variation,
}

# metrics that also need the series' own training history
SCALED_METRICS = ("mase", "rmsse")


@dataclass(frozen=True)
class PandasMetric:
    """A user metric ``(actual, predicted) -> float`` over two pandas Series."""

    function: Callable

    @property
    def __name__(self) -> str:
        return self.function.__name__


def check_metric(metric: str | Callable) -> str | Callable:
    if isinstance(metric, str):
        if metric not in METRICS and metric not in SCALED_METRICS:
            known = ", ".join([*METRICS, *SCALED_METRICS])
            raise ValueError(f"unknown metric {metric!r}; known metrics: {known}")
    elif not callable(metric) and not isinstance(metric, PandasMetric):
        raise ValueError(f"{metric!r} is neither a metric name nor a function")
    return metric


def check_metrics(metrics: Iterable[str | Callable]) -> list[str | Callable]:
    return [check_metric(metric) for metric in metrics]


def metric_name(metric: str | Callable) -> str:
    return metric if isinstance(metric, str) else metric.__name__
