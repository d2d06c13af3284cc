"""Demand-pattern classes after Syntetos and Boylan (2005)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.config import Settings

# The published thresholds; both compare with a strict "greater than".
ADI_THRESHOLD = 1.32
CV2_THRESHOLD = 0.49


def demand_classes(
    filled: DataFrame,
    cfg: Settings,
    adi_threshold: float = ADI_THRESHOLD,
    cv2_threshold: float = CV2_THRESHOLD,
) -> DataFrame:
    """Average demand interval, squared variation of the demand sizes, and the class.

    A series without any positive demand has no interval and is ``no_demand``. The variation
    comes from exact sums of whole millionths, so no order of rows changes it; where a value
    or sum has more than 38 digits, it comes from floating-point moments instead.
    """
    positive = F.when(F.col(cfg.target_column) > 0, F.col(cfg.target_column))
    exact = F.round(positive, 6).try_cast("decimal(18,6)")
    measured = filled.groupBy(*cfg.groups).agg(
        F.count(F.lit(1)).alias("count"),
        F.count(positive).alias("_n"),
        F.count(exact).alias("_exact"),
        F.try_sum(exact).cast("double").alias("_sum"),
        F.try_sum(exact * exact).cast("double").alias("_squares"),
        F.pow(F.stddev_pop(positive) / F.avg(positive), 2).alias("_moments"),
    )
    square = F.col("_sum") * F.col("_sum")
    varied = F.when((F.col("_exact") == F.col("_n")) & (square > 0), (F.col("_n") * F.col("_squares") - square) / square)
    rare, wild = F.col("adi") > adi_threshold, F.col("cv2") > cv2_threshold
    return (
        measured.withColumn("adi", F.when(F.col("_n") > 0, F.col("count") / F.col("_n")))
        .withColumn("cv2", F.coalesce(varied, "_moments"))
        .withColumn(
            "class",
            F.when(F.col("_n") == 0, "no_demand")
            .when(rare & wild, "lumpy")
            .when(rare, "intermittent")
            .when(wild, "erratic")
            .otherwise("smooth"),
        )
        .select(*cfg.groups, "adi", "cv2", "class", "count")
    )


def class_distribution(classes: DataFrame) -> DataFrame:
    """Series per class and their percentage."""
    # at most five rows reach the unpartitioned window
    everything = Window.partitionBy(F.lit(1))
    return (
        classes.groupBy("class")
        .agg(F.count(F.lit(1)).alias("series"))
        .withColumn("pct", F.round(100.0 * F.col("series") / F.sum("series").over(everything), 2))
    )


def class_samples(
    filled: DataFrame,
    classes: DataFrame,
    cfg: Settings,
    per_class: int | None = 9,
    min_count: int = 7,
    only: str | None = None,
) -> DataFrame:
    """Rows of the first series of each class, with the class attached.

    The row number is limited before the shuffle too, so no task sees more than
    ``per_class`` series of a class from each of its inputs. ``per_class=None`` keeps
    every series, ``only`` one class.
    """
    chosen = classes.filter(F.col("count") >= min_count)
    if only is not None:
        chosen = chosen.filter(F.col("class") == only)
    if per_class is not None:
        order = Window.partitionBy("class").orderBy(*cfg.groups)
        chosen = (
            chosen.withColumn("_rank", F.row_number().over(order))
            .filter(F.col("_rank") <= per_class)
            .drop("_rank")
        )
        chosen = F.broadcast(chosen) if per_class <= 10_000 else chosen
    return filled.join(chosen, on=cfg.groups, how="inner").select(
        *cfg.groups, cfg.time_column, cfg.target_column, "adi", "cv2", "class", "count"
    )
