"""Daily series: history window, gap filling, chronological split, array form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.config import Settings


def history_window(df: DataFrame, cfg: Settings) -> DataFrame:
    """Rows from ``time_delta`` periods before execution to the day before it."""
    return df.filter(F.col(cfg.time_column).between(F.lit(cfg.start_date), F.lit(cfg.end_date)))


def _fill(df: DataFrame, cfg: Settings, stop: Column) -> DataFrame:
    """Add zero rows from each series' first day up to, not including, ``stop``.

    Each row is followed by the days missing before the next one. That is one window
    over a series, whose rows are bounded by the days of history, and no join.
    """
    time, target = F.col(cfg.time_column), F.col(cfg.target_column)
    order = Window.partitionBy(*cfg.groups).orderBy(cfg.time_column)
    following = df.select(
        *cfg.groups, time, target, F.coalesce(F.lead(cfg.time_column).over(order), stop).alias("_next")
    )
    span = F.when(
        F.col("_next") > time,
        F.sequence(time, F.date_sub("_next", 1), F.expr(f"interval {cfg.freq_days} day")),
    ).otherwise(F.array(time))
    known = F.coalesce(target, F.lit(0.0))
    # a span is never empty; the outer form only spares the optimizer's filter on its size
    return following.withColumn("_day", F.explode_outer(span)).select(
        *cfg.groups,
        F.col("_day").alias(cfg.time_column),
        F.when(F.col("_day") == time, known).otherwise(0.0).alias(cfg.target_column),
    )


def gap_fill(df: DataFrame, cfg: Settings) -> DataFrame:
    """Gapless series from the first day seen in ``df`` to the day before execution."""
    return _fill(df, cfg, F.lit(cfg.execution_date))


def gap_fill_global(df: DataFrame, cfg: Settings) -> DataFrame:
    """Gapless series from their first day to the last day of all series."""
    last = df.agg(F.max(cfg.time_column)).scalar()
    return _fill(df, cfg, F.date_add(last, 1))


def train_test_split(df: DataFrame, cfg: Settings) -> DataFrame:
    """Label the last ``test_size`` periods ``test``, everything before ``train``."""
    late = F.col(cfg.time_column) > F.lit(cfg.train_end)
    return df.withColumn("split", F.when(late, "test").otherwise("train"))


def prepare_series(df: DataFrame, cfg: Settings) -> DataFrame:
    """Window, fill and label in one pass over the daily demand."""
    filled = train_test_split(gap_fill(history_window(df, cfg), cfg), cfg)
    return filled.select(*cfg.groups, cfg.time_column, cfg.target_column, "split")


def series_arrays(split: DataFrame, cfg: Settings) -> DataFrame:
    """One row per series: first day, values in day order, number of training days.

    An array holds one value per day of the history window. Rows of ``split`` that
    still sit where the gap fill put them need no further shuffle here.
    """
    points = F.array_sort(F.collect_list(F.struct(cfg.time_column, cfg.target_column)))
    return (
        split.groupBy(*cfg.groups)
        .agg(points.alias("_points"), F.count_if(F.col("split") == "train").alias("n_train"))
        .select(
            *cfg.groups,
            F.col("_points")[0][cfg.time_column].alias("first_day"),
            F.transform("_points", lambda p: p[cfg.target_column]).alias("y"),
            F.col("n_train").cast("int").alias("n_train"),
        )
    )


def series_count(df: DataFrame, cfg: Settings) -> DataFrame:
    return df.select(*cfg.groups).distinct().agg(F.count(F.lit(1)).alias("series"))
