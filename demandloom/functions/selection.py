"""Exact medians that no single task has to hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# bins per doubling of the value, and bins inside one of those
FINE = 128
FINER = 4096
# keeps negative, zero and positive bins apart; doubles span 2**-1074 to 2**1024
_OFFSET = 2_000 * FINE


def exact_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key: median, mean and count of the values that are numbers.

    A built-in median keeps every value of a key in one buffer, and a key here may be
    one of seven models over all series. Instead equal values are counted first, then
    two histograms narrow each key to the bins that hold its two middle values, and
    only those are sorted. Bins are logarithmic, then even, so neither a long tail nor
    a narrow peak puts most values in one.
    """
    rows = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    counted = (
        rows.groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bin", _log_bin())
    )

    every = Window.partitionBy(*keys)
    coarse = (
        counted.groupBy(*keys, "_bin")
        .agg(
            F.sum("_n").alias("_in"),
            F.sum(F.col("_v") * F.col("_n")).alias("_total"),
            F.min("_v").alias("_lo"),
            F.max("_v").alias("_hi"),
        )
        .withColumn("count", F.sum("_in").over(every))
        .withColumn("mean", F.sum("_total").over(every) / F.col("count"))
        .withColumn("_before", _running("_in", keys, "_bin"))
        .filter(_middle("_in"))
        .select(*keys, "_bin", "_before", "count", "mean", "_lo", "_hi")
    )
    near = counted.join(coarse, [*keys, "_bin"]).withColumn("_cell", _even_bin())

    cell = [*keys, "_bin", "_cell"]
    fine = (
        near.groupBy(*cell, "_before", "count")
        .agg(F.sum("_n").alias("_in"))
        .withColumn("_before", F.col("_before") + _running("_in", [*keys, "_bin"], "_cell"))
        .filter(_middle("_in"))
        .select(*cell, F.col("_before").alias("_start"))
    )
    ranked = (
        near.join(fine, cell)
        .withColumn("_before", F.col("_start") + _running("_n", cell, "_v"))
        .filter(_middle("_n"))
    )
    return ranked.groupBy(*keys, "mean", "count").agg(
        ((F.min("_v") + F.max("_v")) / 2.0).alias("median")
    )


def _running(amount: str, keys: list[str], order: str) -> Column:
    """Amount in the rows before this one."""
    return F.sum(amount).over(Window.partitionBy(*keys).orderBy(order)) - F.col(amount)


def _middle(amount: str) -> Column:
    """Whether ranks _before+1 .. _before+amount hold one of the two middle ranks."""
    low = F.floor((F.col("count") + 1) / 2)
    high = F.floor(F.col("count") / 2) + 1
    return (F.col("_before") < high) & (F.col("_before") + F.col(amount) >= low)


def _log_bin() -> Column:
    v = F.col("_v")
    # infinity goes to a bin of its own, above every finite value
    size = F.floor(F.least(F.log2(F.abs(v)), F.lit(1_100.0)) * FINE) + _OFFSET
    signed = F.when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size)
    # never null: without the coalesce a join infers a filter that keeps the optimizer
    # from reusing the shuffle of the counted values
    return F.coalesce(signed.cast("long"), F.lit(0))


def _even_bin() -> Column:
    share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    inside = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor(share * FINER), F.lit(FINER - 1)))
    return F.coalesce(inside, F.lit(0))
