"""Scoring forecasts, choosing a champion per series, and summarising both."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.config import Settings
from demandloom.functions.metrics import (
    METRICS,
    SCALED_METRICS,
    PandasMetric,
    check_metrics,
    metric_name,
)
from demandloom.functions.selection import exact_median


def paired_with_actuals(test: DataFrame, forecasts: DataFrame, cfg: Settings) -> DataFrame:
    """Inner join of test actuals and forecasts on groups and time.

    Actuals are gathered into one row per series, at most ``test_size`` days long, and
    the join is on the series alone. The forecasts then move once: what follows per
    (model, series) finds them partitioned already.
    """
    time, target = cfg.time_column, cfg.target_column
    actuals = test.groupBy(*cfg.groups).agg(
        F.collect_list(F.struct(F.col(time).alias("day"), F.col(target).alias("actual"))).alias("_actuals")
    )
    joined = forecasts.withColumnRenamed(target, "prediction").join(actuals, cfg.groups, "inner")
    same_day = F.filter("_actuals", lambda a: a["day"] == F.col(time))
    return joined.select("model", *cfg.groups, time, "prediction", F.inline(same_day)).select(
        "model", *cfg.groups, time, F.col("actual").alias(target), "prediction"
    )


def training_scale(train: DataFrame, cfg: Settings) -> DataFrame:
    """Mean absolute and mean squared one-step change of each series' training days."""
    order = Window.partitionBy(*cfg.groups).orderBy(cfg.time_column)
    change = F.abs(F.col(cfg.target_column) - F.lag(cfg.target_column).over(order))
    steps = train.select(*cfg.groups, change.alias("_change"))
    squared = F.col("_change") * F.col("_change")
    return steps.groupBy(*cfg.groups).agg(F.avg("_change").alias("_scale"), F.avg(squared).alias("_square"))


def forecast_metrics(
    test: DataFrame,
    forecasts: DataFrame,
    cfg: Settings,
    metrics: Sequence[str | Callable] | None = None,
    train: DataFrame | None = None,
) -> DataFrame:
    """One row per model, series and metric: (model, *groups, metric, value).

    Metrics are names, functions of two columns, or ``PandasMetric`` around a function
    of two pandas Series. ``mase`` and ``rmsse`` need the training rows.
    """
    return score(paired_with_actuals(test, forecasts, cfg), cfg, metrics, train)


def score(
    pairs: DataFrame,
    cfg: Settings,
    metrics: Sequence[str | Callable] | None = None,
    train: DataFrame | None = None,
) -> DataFrame:
    """Metrics of (model, *groups, target, prediction) rows."""
    metrics = check_metrics(metrics if metrics is not None else cfg.metrics)
    keys = ["model", *cfg.groups]
    y, p = F.col(cfg.target_column), F.col("prediction")

    native: dict[str, Column] = {}
    for metric in metrics:
        if isinstance(metric, PandasMetric) or metric in SCALED_METRICS:
            continue
        function = METRICS[metric] if isinstance(metric, str) else metric
        native[metric_name(metric)] = function(y, p)
    scaled = [m for m in metrics if m in SCALED_METRICS]
    if scaled:
        if train is None:
            raise ValueError(f"{scaled[0]} needs the training rows: pass train=")
        pairs = pairs.join(training_scale(train, cfg), cfg.groups, "left")
        scale, square = F.first("_scale"), F.first("_square")
        found = {
            "mase": F.when(scale > 0, F.avg(F.abs(y - p)) / scale),
            "rmsse": F.when(square > 0, F.sqrt(F.avg((y - p) * (y - p)) / square)),
        }
        native |= {name: found[name] for name in scaled}

    parts = []
    if native:
        wide = pairs.groupBy(*keys).agg(*(c.cast("double").alias(n) for n, c in native.items()))
        parts.append(_long(wide, keys, list(native)))
    for metric in metrics:
        if isinstance(metric, PandasMetric):
            parts.append(_pandas_metric(pairs, keys, cfg, metric))
    return reduce(DataFrame.unionByName, parts)


def _long(wide: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names))
    return wide.select(*keys, F.inline(rows))


def _pandas_metric(pairs: DataFrame, keys: list[str], cfg: Settings, metric: PandasMetric) -> DataFrame:
    function, name = metric.function, metric.__name__

    @F.pandas_udf("double")
    def score(y: pd.Series, p: pd.Series) -> float:
        return float(function(y, p))

    value = score(cfg.target_column, "prediction").alias("value")
    return pairs.groupBy(*keys).agg(value).select(*keys, F.lit(name).alias("metric"), "value")


def best_models(metrics: DataFrame, cfg: Settings, metric: str | None = None) -> DataFrame:
    """The model with the smallest value per series; equal values go to the first name.

    Null and NaN values never win: a null would sort before every number.
    """
    metric = metric or cfg.selection_metric
    value = F.col("value")
    usable = (F.col("metric") == metric) & value.isNotNull() & ~F.isnan(value)
    return (
        metrics.filter(usable)
        .groupBy(*cfg.groups)
        .agg(F.min(F.struct("value", "model")).alias("_best"))
        .select(
            F.col("_best.model").alias("model"),
            *cfg.groups,
            F.lit(metric).alias("metric"),
            F.col("_best.value").alias("value"),
        )
    )


def champion_forecast(forecasts: DataFrame, champions: DataFrame, cfg: Settings) -> DataFrame:
    """Forecast rows of each series' champion.

    Champions are unique per series and grow with the data, so no broadcast is forced;
    adaptive execution may still choose one from measured sizes.
    """
    keys = ["model", *cfg.groups]
    return forecasts.join(champions.select(*keys), keys, "left_semi")


def champion_mean_metric(champions: DataFrame) -> DataFrame:
    return champions.agg(F.avg("value").alias("value"))


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Median, mean and count of the metric values of each model."""
    return exact_median(metrics, ["model"], "value").select("model", "median", "mean", "count")
