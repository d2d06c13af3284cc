"""Champion forecasts to published rolling demand, with a fallback for the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.config import Settings


def weekly_forecast(forecast: DataFrame, cfg: Settings) -> DataFrame:
    """Sum of each day and the next ``window_size - 1``, for days with a whole window.

    Sum and row count share one frame, so one sort serves both.
    """
    ahead = (
        Window.partitionBy(*cfg.groups)
        .orderBy(cfg.time_column)
        .rowsBetween(0, cfg.window_size - 1)
    )
    return (
        forecast.select(
            *cfg.groups,
            cfg.time_column,
            F.sum(cfg.target_column).over(ahead).alias(cfg.target_column),
            F.count(F.lit(1)).over(ahead).alias("_days"),
        )
        .filter(F.col("_days") == cfg.window_size)
        .drop("_days")
    )


def output_periods(weekly: DataFrame, cfg: Settings) -> DataFrame:
    return weekly.select(cfg.time_column).distinct()


def unforecast_rows(demand: DataFrame, weekly: DataFrame, cfg: Settings) -> DataFrame:
    """Demand rows of the series that have no forecast."""
    return demand.join(weekly.select(*cfg.groups).distinct(), cfg.groups, "left_anti")


def unforecast_series(demand: DataFrame, weekly: DataFrame, cfg: Settings) -> DataFrame:
    return unforecast_rows(demand, weekly, cfg).select(*cfg.groups).distinct()


def fallback_forecast(demand: DataFrame, weekly: DataFrame, cfg: Settings) -> DataFrame:
    """Mean observed daily demand of each series without a forecast, on every period.

    The periods are the few dates the weekly forecast holds; they come as one array
    from a scalar subquery. No forecast at all means no periods and no rows. Demand is
    averaged per series before the anti join, so the join moves one row per series.
    """
    periods = output_periods(weekly, cfg).agg(F.collect_set(cfg.time_column)).scalar()
    level = F.avg(cfg.target_column)
    if cfg.scale_fallback:
        level = level * F.lit(float(cfg.window_size))
    means = demand.groupBy(*cfg.groups).agg(level.alias(cfg.target_column))
    return unforecast_rows(means, weekly, cfg).select(
        *cfg.groups, F.explode(periods).alias(cfg.time_column), cfg.target_column
    )


def demand_output(weekly: DataFrame, fallback: DataFrame, cfg: Settings) -> DataFrame:
    """Forecasts and fallbacks together, never below zero."""
    both = weekly.unionByName(fallback)
    return both.withColumn(cfg.target_column, F.greatest(F.col(cfg.target_column), F.lit(0.0)))


def publish_demand(demand: DataFrame, forecast: DataFrame, cfg: Settings) -> DataFrame:
    weekly = weekly_forecast(forecast, cfg)
    return demand_output(weekly, fallback_forecast(demand, weekly, cfg), cfg)
