"""Tree ensembles on lagged values, fitted once over all series.

Targets are divided by the mean size of their series' values, so that large series do not
dominate, and multiplied back after prediction. How trees grow is in ``trees``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.config import Settings
from demandloom.durable import durable, release
from demandloom.functions.arrays import mean
from demandloom.models import trees as T

LAGS = 7
BINS = 64


def lag_features(df: DataFrame, cfg: Settings, lags: int = LAGS) -> DataFrame:
    """The previous ``lags`` values and the weekday of every day that has them all."""
    order = Window.partitionBy(*cfg.groups).orderBy(cfg.time_column)
    lagged = [
        F.lag(cfg.target_column, k).over(order).alias(f"lag_{k}") for k in range(1, lags + 1)
    ]
    return df.select(
        *cfg.groups,
        cfg.time_column,
        cfg.target_column,
        *lagged,
        F.weekday(cfg.time_column).alias("weekday"),
    ).filter(F.col(f"lag_{lags}").isNotNull())


def scaled_series(known: DataFrame, cfg: Settings, lags: int) -> DataFrame:
    """Series with more than ``lags`` values, all finite, as shares of their mean size.

    No share is larger than the number of values, whatever their signs.
    """
    finite = F.forall("y", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    level = mean(F.transform("y", F.abs))
    return (
        known.filter((F.size("y") > lags) & finite)
        .withColumn("_scale", F.when(level > 0, level).otherwise(1.0))
        .withColumn("_z", F.transform("y", lambda x: x / F.col("_scale")))
    )


def training_rows(scaled: DataFrame, cfg: Settings, lags: int) -> DataFrame:
    """(features, label, key) per day of every series, straight from the arrays: the lags, the
    weekday, the day's value, and a hash of series and day that decides on the row's bags."""
    starts = F.sequence(F.lit(1), F.size("_z") - lags)
    rows = scaled.select(
        *cfg.groups,
        "first_day",
        F.explode(
            F.transform(
                starts,
                lambda i: F.struct(
                    F.slice(F.col("_z"), i, F.lit(lags)).alias("window"),
                    F.element_at(F.col("_z"), i + lags).alias("label"),
                    ((i + (lags - 1)) * cfg.freq_days).alias("offset"),
                ),
            )
        ).alias("r"),
    ).withColumn("_day", F.date_add("first_day", F.col("r.offset")))
    told = F.md5(F.concat_ws("|", *(F.col(g).cast("string") for g in cfg.groups), F.col("_day").cast("string")))
    return rows.select(
        F.concat(F.col("r.window"), F.array(F.weekday("_day").cast("double"))).alias("features"),
        F.col("r.label").alias("label"),
        (F.conv(F.substring(told, 1, 8), 16, 10).cast("long") % T.HASH).alias("key"),
    )


def fit(known: DataFrame, cfg: Settings, lags: int, growth: T.Growth, boosted: bool, bins: int = BINS) -> T.Ensemble | None:
    """The ensemble learned from all series, or None where none is long enough.

    The trees depend on the rows alone, neither on their order nor on their partitions.
    """
    if not T.WEEKDAYS <= bins <= 256:
        raise ValueError("bins must be between 7 and 256")
    scaled = durable(scaled_series(known, cfg, lags))
    cuts = T.cut_points(scaled.select(F.explode("_z").alias("z")), "z", bins)
    labels = scaled.select(F.explode(F.slice("_z", F.lit(lags + 1), F.size("_z") - lags)).alias("z"))
    whole = labels.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.floor(F.col("z") * T.MICRO + 0.5).cast("decimal(38,0)")).alias("z"),
    ).first()
    # a pass over the blocks is a job: no more tasks than there are full blocks, which changes
    # no tree
    packed = T.pack(training_rows(scaled, cfg, lags), lags, cuts)
    parts = max(1, -(-whole["n"] // T.BLOCK))
    blocks = durable(packed.coalesce(parts))
    model = None
    if whole["n"]:
        if boosted:
            base = float(whole["z"]) / whole["n"] / T.MICRO
            model = T.fit_boosted(blocks, growth, cuts, lags + 1, base, parts == 1)
        else:
            model = T.fit_forest(blocks, growth, cuts, lags + 1, parts == 1)
    release(blocks)
    release(scaled)
    return model


def tree_table(known: DataFrame, model: T.Ensemble | None) -> DataFrame:
    """The splits of an ensemble: (tree, node, feature, bin, gain), for reports on what the
    trees look at. Nodes are in heap order; features 0 to lags - 1 are the lags, oldest first,
    and the last is the weekday."""
    rows = [
        (t, int(i), int(tree.feature[i]), int(tree.bin[i]), float(tree.gain[i]))
        for t, tree in enumerate(model.trees if model else [])
        for i in (tree.feature >= 0).nonzero()[0]
    ]
    kinds = "tree long, node long, feature long, bin long, gain double"
    return known.sparkSession.createDataFrame(rows, kinds)


def _forecast(
    known: DataFrame, cfg: Settings, steps: int, label: str, lags: int, wanted: Column | None,
    growth: T.Growth, boosted: bool, bins: int,
) -> DataFrame:
    """(model, groups, _start, _path): fit on all series, then predict step by step."""
    model = fit(known, cfg, lags, growth, boosted, bins)
    own = scaled_series(known.filter(F.lit(True) if wanted is None else wanted), cfg, lags)
    start = F.date_add("first_day", F.size("_z") * cfg.freq_days)
    if model is None:
        path = F.array().cast("array<double>")
    else:
        shares = T.path_forecaster(model, steps, lags, cfg.freq_days)
        path = F.transform(shares("_z", F.weekday(start)), lambda x: x * F.col("_scale"))
    return own.select(F.lit(label).alias("model"), *cfg.groups, start.alias("_start"), path.alias("_path"))


def random_forest(
    known: DataFrame,
    cfg: Settings,
    steps: int,
    label: str = "RandomForest",
    lags: int = LAGS,
    trees: int = 100,
    depth: int = 6,
    min_weight: float = 1.0,
    column_share: float = 1.0,
    bins: int = BINS,
    seed: int = 0,
    wanted: Column | None = None,
) -> DataFrame:
    growth = T.Growth(trees=trees, depth=depth, min_weight=min_weight, column_share=column_share, seed=seed)
    return _forecast(known, cfg, steps, label, lags, wanted, growth, False, bins)


def gbt(
    known: DataFrame,
    cfg: Settings,
    steps: int,
    label: str = "GradientBoostedTrees",
    lags: int = LAGS,
    trees: int = 100,
    depth: int = 6,
    step_size: float = 0.3,
    l1: float = 0.0,
    l2: float = 1.0,
    gamma: float = 0.0,
    min_weight: float = 1.0,
    row_share: float = 1.0,
    column_share: float = 1.0,
    bins: int = BINS,
    seed: int = 0,
    wanted: Column | None = None,
) -> DataFrame:
    growth = T.Growth(
        trees=trees, depth=depth, step=step_size, l1=l1, l2=l2, gamma=gamma, min_weight=min_weight,
        row_share=row_share, column_share=column_share, seed=seed,
    )
    return _forecast(known, cfg, steps, label, lags, wanted, growth, True, bins)
