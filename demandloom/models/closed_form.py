"""Forecast methods that are one expression over a series array.

Each builder takes the history as an ``array<double>`` column and the number of
steps, and returns the forecast as an ``array<double>`` column. Nothing leaves the
JVM and nothing shuffles: a model is one more column on the series row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandloom.functions.arrays import counting, mean, total


def mean_forecast(y: Column, steps: int) -> Column:
    """The mean of the history, repeated."""
    return F.array_repeat(mean(y), steps)


def moving_average(y: Column, steps: int, window: int = 7) -> Column:
    """Each step is the mean of the last ``window`` values, earlier steps included."""
    return F.aggregate(
        counting(steps),
        F.slice(y, -window, window),
        lambda acc, _: F.concat(acc, F.array(mean(F.slice(acc, -window, window)))),
        lambda acc: F.slice(acc, window + 1, steps),
    )


# Fixed value: the smoothing constant of both averages.
CROSTON_ALPHA = 0.1


def croston(y: Column, steps: int, version: str = "sba", alpha: float = CROSTON_ALPHA) -> Column:
    """Croston (1972): smoothed demand size over smoothed demand interval.

    ``sba`` multiplies by 1 - alpha/2 (Syntetos and Boylan, 2005). A series without
    demand is forecast as 0.
    """
    if version not in ("sba", "classic"):
        raise ValueError(f"unknown Croston version {version!r}: use 'sba' or 'classic'")
    factor = 1.0 - alpha / 2.0 if version == "sba" else 1.0
    unknown = F.lit(None).cast("double")

    def smooth(old: Column, new: Column) -> Column:
        return F.coalesce(old + F.lit(alpha) * (new - old), new)

    def step(state: Column, x: Column) -> Column:
        sold = x > 0
        return F.struct(
            F.when(sold, smooth(state["size"], x)).otherwise(state["size"]).alias("size"),
            F.when(sold, smooth(state["interval"], state["gap"]))
            .otherwise(state["interval"])
            .alias("interval"),
            F.when(sold, 1.0).otherwise(state["gap"] + 1.0).alias("gap"),
        )

    start = F.struct(unknown.alias("size"), unknown.alias("interval"), F.lit(1.0).alias("gap"))
    rate = F.aggregate(
        y, start, step, lambda s: F.coalesce(F.lit(factor) * s["size"] / s["interval"], F.lit(0.0))
    )
    return F.array_repeat(rate, steps)


def trend_seasonal(y: Column, steps: int, period: int = 7) -> Column:
    """Least-squares line plus the centred mean residual of each day of the period.

    Additive decomposition in the spirit of Taylor and Letham (2018). Series shorter
    than two periods get the line only.
    """
    n = F.size(y)
    sums = F.struct(
        n.cast("double").alias("n"),
        total(y).alias("y"),
        total(F.transform(y, lambda v, i: v * (i + 1))).alias("ty"),
    )

    def line(s: Column) -> Column:
        # days are 1..n, so their sum and sum of squares have closed forms
        t = s["n"] * (s["n"] + 1.0) / 2.0
        tt = t * (2.0 * s["n"] + 1.0) / 3.0
        slope = (s["n"] * s["ty"] - t * s["y"]) / (s["n"] * tt - t * t)
        return F.struct(slope.alias("slope"), ((s["y"] - slope * t) / s["n"]).alias("level"))

    def mean_residual(fitted: Column, k: Column) -> Column:
        """Of days k, k + period, ...: their mean value minus the line at their mean day."""
        days = F.sequence(k, n, F.lit(period))
        sold = F.aggregate(days, F.lit(0.0), lambda acc, t: acc + F.element_at(y, t))
        mid = k + (F.size(days) - 1) * (period / 2.0)
        return sold / F.size(days) - fitted["level"] - fitted["slope"] * mid

    def effects(fitted: Column) -> Column:
        by_day = F.transform(counting(period), lambda k: mean_residual(fitted, k))
        centre = F.struct(by_day.alias("effect"), mean(by_day).alias("mean"))
        return F.when(n >= 2 * period, centre).otherwise(
            F.struct(F.array_repeat(F.lit(0.0), period).alias("effect"), F.lit(0.0).alias("mean"))
        )

    def project(fitted: Column) -> Column:
        def path(e: Column) -> Column:
            return F.transform(
                counting(steps),
                lambda h: fitted["level"]
                + fitted["slope"] * (n + h)
                + F.element_at(e["effect"], F.pmod(n + h - 1, F.lit(period)) + 1)
                - e["mean"],
            )

        return _let(effects(fitted), path)

    return _let(_let(sums, line), project)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Name a value inside an expression, so that it is computed once per row."""
    return F.transform(F.array(value), use)[0]
