"""User models: any function ``(pdf, steps, **params) -> pdf`` run per series.

The function gets one series as a pandas frame (time, target, groups), whose length is
bounded by the history window, and returns ``steps`` rows with the time and target
columns: a finite value for each of the days ahead. Anything else is an error of that
series, and no forecast.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator, Mapping
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.config import Settings
from demandloom.durable import durable

TOGETHER = 256  # series whose forecasts leave a task in one frame

_MODELS: dict[str, Callable[..., pd.DataFrame]] = {}


def register_model(name: str, function: Callable[..., pd.DataFrame]) -> None:
    _MODELS[name] = function


def register_class(name: str, model: type | str) -> None:
    """A class with ``fit(series)`` and ``predict(n)``, or its name in dotted form.

    Each series gets an object of its own, built with the model's parameters; the series is
    pandas, indexed by day. ``predict`` returns one value per day ahead; a result of
    several columns is an error of the series.
    """
    if isinstance(model, str):
        module, _, attribute = model.rpartition(".")
        model = getattr(importlib.import_module(module), attribute)

    def run(pdf: pd.DataFrame, steps: int, **params) -> pd.DataFrame:
        time, target = pdf.columns[:2]
        days = pd.DatetimeIndex(pd.to_datetime(pdf[time]))
        fitted = model(**params)
        fitted.fit(pd.Series(pdf[target].to_numpy(), index=days))
        values = np.asarray(fitted.predict(steps), dtype=float)
        if values.ndim != 1:
            raise ValueError("incomplete forecast: not one value per day")
        period = days[-1] - days[-2] if len(days) > 1 else pd.Timedelta(days=1)
        ahead = [(days[-1] + k * period).date() for k in range(1, len(values) + 1)]
        return pd.DataFrame({time: ahead, target: values})

    register_model(name, run)


def registered() -> list[str]:
    return list(_MODELS)


def _last_value():
    # built in here, it travels to the executors by value
    def last_value(pdf: pd.DataFrame, steps: int) -> pd.DataFrame:
        """The last value carried forward: the worked example of a plug-in."""
        time, target = pdf.columns[:2]
        days = pd.to_datetime(pdf[time])
        period = days.iloc[-1] - days.iloc[-2] if len(days) > 1 else pd.Timedelta(days=1)
        ahead = [(days.iloc[-1] + k * period).date() for k in range(1, steps + 1)]
        return pd.DataFrame({time: ahead, target: float(pdf[target].iloc[-1])})

    return last_value


last_value = _last_value()
register_model("last_value", last_value)


def plugin_forecast(
    known: DataFrame,
    cfg: Settings,
    steps: int,
    label: str,
    model: str,
    params: Mapping[str, Any] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Forecasts of one plug-in model, and one error row per series it failed on."""
    result = durable(_run(known, cfg, steps, label, model, params))
    forecasts = result.filter(F.col("error").isNull()).drop("error")
    errors = result.filter(F.col("error").isNotNull()).select("model", *cfg.groups, "error")
    return forecasts, errors


def plugin_forecast_only(known, cfg, steps, label, model, params=None) -> DataFrame:
    """As ``plugin_forecast`` without the error rows, and so without writing anything."""
    result = _run(known, cfg, steps, label, model, params)
    return result.filter(F.col("error").isNull()).drop("error")


def _run(known, cfg, steps, label, model, params) -> DataFrame:
    if model not in _MODELS:
        raise ValueError(f"unknown model {model!r}; registered models: {', '.join(_MODELS)}")
    function, params = _MODELS[model], dict(params or {})
    groups, time, target, freq = cfg.groups, cfg.time_column, cfg.target_column, cfg.freq_days
    columns = [*groups, time, target, "error"]

    def forecast_one(row) -> pd.DataFrame:
        values = list(row["y"])
        days = pd.date_range(pd.Timestamp(row["first_day"]), periods=len(values), freq=f"{freq}D")
        history = pd.DataFrame({time: days.date, target: values})
        for name in groups:
            history[name] = row[name]
        try:
            found = function(history, steps, **params)
            forecast = pd.DataFrame(
                {
                    time: pd.to_datetime(found[time]).dt.date.to_numpy(),
                    target: found[target].astype("float64").to_numpy(),
                    "error": None,
                }
            ).sort_values(time, ignore_index=True)
            ahead = pd.date_range(days[-1], periods=steps + 1, freq=f"{freq}D")[1:]
            if list(forecast[time]) != list(ahead.date):
                raise ValueError(f"incomplete forecast: not the {steps} days ahead")
            if not np.isfinite(forecast[target]).all():
                raise ValueError("incomplete forecast: values that are not finite")
        except Exception as failure:  # one bad series must not fail the others
            forecast = pd.DataFrame(
                {time: [None], target: [None], "error": [f"{type(failure).__name__}: {failure}"]}
            )
        for name in groups:
            forecast[name] = row[name]
        return forecast[columns]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = frame.to_dict("records")
            for start in range(0, len(rows), TOGETHER):
                parts = [forecast_one(row) for row in rows[start : start + TOGETHER]]
                yield pd.DataFrame({c: np.concatenate([p[c].to_numpy(object) for p in parts]) for c in columns})

    fields = [known.schema[name] for name in groups]
    schema = T.StructType(
        [
            *fields,
            T.StructField(time, T.DateType()),
            T.StructField(target, T.DoubleType()),
            T.StructField("error", T.StringType()),
        ]
    )
    # a series is one row: it is forecast where it lies, without a shuffle
    found = known.select(*groups, "first_day", "y").mapInPandas(run, schema)
    return found.select(F.lit(label).alias("model"), *columns)
