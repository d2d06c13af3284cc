"""Reports over the result tables."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.config import Settings
from demandloom.durable import durable

# Labels of the report rows that are not a model's own.
CHAMPION = "Champion"
ACTUAL = "Sales"


def metrics_with_champion(
    metrics: DataFrame, champions: DataFrame, metric: str = "mae"
) -> DataFrame:
    """Metrics of one name together with the champions, labelled as one more model.

    Champion rows keep whatever metric they were chosen by. Equal rows appear once.
    """
    columns = metrics.columns
    labelled = champions.withColumn("model", F.lit(CHAMPION)).select(*columns)
    return metrics.filter(F.col("metric") == metric).union(labelled).distinct()


def champion_vs_actual(
    forecast_on_test: DataFrame, champions: DataFrame, split: DataFrame, cfg: Settings
) -> DataFrame:
    """Test-period forecasts of every model and of the champions, and actual sales."""
    columns = ["model", *cfg.groups, cfg.time_column, cfg.target_column]
    keys = ["model", *cfg.groups]
    chosen = forecast_on_test.join(champions.select(*keys), keys, "inner").withColumn(
        "model", F.lit(CHAMPION)
    )
    actual = split.filter(F.col("split") == "test").withColumn("model", F.lit(ACTUAL))
    parts = (chosen, forecast_on_test, actual)
    first, second, third = (part.select(*columns) for part in parts)
    return first.union(second).union(third).distinct()


def volume_by(df: DataFrame, keys: list[str], cfg: Settings) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(cfg.target_column).alias(cfg.target_column))


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one frame missing from the other, as a multiset, labelled by side.

    Equal rows are counted before they move, so a group of copies is not one task's work.
    ``ordered_diff`` compares the order of rows as well.
    """
    only_left = left.exceptAll(right).withColumn("side", F.lit("left"))
    only_right = right.exceptAll(left).withColumn("side", F.lit("right"))
    return only_left.unionByName(only_right).select("side", *left.columns)


def head(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows of an order; tasks keep no more than ``n`` rows each. The order
    should be total, or which of equal rows come first is open."""
    return df.orderBy(*order).limit(n)


POSITION = "_position"


def with_row_index(df: DataFrame, name: str = POSITION) -> DataFrame:
    """Rows numbered from 0 in the order they have: by partition, then within it.

    Spark numbers the rows of each partition; counting them gives one number per partition, and
    the sums of those before it are joined back. No window sees more than its partition. The
    rows are written once, so that both passes see the same.
    """
    spark = df.sparkSession
    numbered = durable(df.withColumn("_at", F.monotonically_increasing_id()))
    # partition in the upper bits, place in the lower 33
    part = F.shiftright("_at", 33)
    counts = numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before = itertools.accumulate((r["n"] for r in counts), initial=0)
    starts = spark.createDataFrame([(r["part"], b) for r, b in zip(counts, before)], "_part long, _before long")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    # one row per partition
    return (
        numbered.join(F.broadcast(starts), part == F.col("_part"))
        .withColumn(name, F.col("_before") + place)
        .select(*df.columns, name)
    )


def ordered_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """As ``table_diff``, with each row's position: equal frames have equal rows in equal order."""
    return table_diff(with_row_index(left), with_row_index(right))
