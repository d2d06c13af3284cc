"""The stages of the daily run, each from catalog tables to catalog tables.

Every stage reads what the stage before it wrote. The tables cut the lineage: a stage
that fails or loses executors restarts from files, not from the raw transactions.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from dataclasses import asdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import schemas
from demandloom.config import Settings
from demandloom.durable import durable
from demandloom.models.roster import (
    FULL_ROSTER,
    check_models,
    closed_form_pairs,
    forecast_with_errors,
)
from demandloom.operators import demand, evaluate, publish, series
from demandloom.sources.files import read_csv_cast
from demandloom.sources.tables import (
    TableSpec,
    append_run_log,
    create_database,
    create_tables,
    read_table,
    replace_partitions,
    replace_table,
)

# Names of the two input files.
SALES_FILE = "product_sales.csv"
GEO_FILE = "geo.csv"


def _read(spark: SparkSession, cfg: Settings, table: str) -> DataFrame:
    return read_table(spark, cfg.database, table)


def _write(cfg: Settings, df: DataFrame, table: str) -> None:
    replace_table(df, cfg.database, TableSpec.of(table))


def _log(spark: SparkSession, cfg: Settings, stage: str, metric=None, value=None) -> None:
    append_run_log(spark, cfg.database, stage, asdict(cfg), metric, value)


def prepare_catalog(spark: SparkSession, cfg: Settings) -> None:
    create_database(spark, cfg.database)
    create_tables(spark, cfg.database)


def ingest(spark: SparkSession, cfg: Settings) -> None:
    """CSV files to ``sales`` and ``geo``; the city list limits geo only."""
    sales = read_csv_cast(spark, os.path.join(cfg.dir, SALES_FILE), schemas.SALES, cfg.sep)
    geo = read_csv_cast(spark, os.path.join(cfg.dir, GEO_FILE), schemas.GEO, cfg.sep)
    _write(cfg, sales, "sales")
    _write(cfg, demand.keep_cities(geo, cfg.cities), "geo")
    _log(spark, cfg, "ingestion")


def build_input(spark: SparkSession, cfg: Settings) -> None:
    """``sales`` and ``geo`` to daily demand in ``input``."""
    daily = demand.daily_demand(_read(spark, cfg, "sales"), _read(spark, cfg, "geo"))
    _write(cfg, daily, "input")
    _log(spark, cfg, "input")


def build_split(spark: SparkSession, cfg: Settings) -> None:
    """``input`` to gapless, labelled series in ``split``."""
    _write(cfg, series.prepare_series(_read(spark, cfg, "input"), cfg), "split")
    _log(spark, cfg, "split")


def build_forecasts(
    spark: SparkSession, cfg: Settings, labels: Iterable[str] | None = None
) -> None:
    """``split`` to ``forecast_on_test``, ``all_models_forecast`` and ``model_errors``.

    One array per series feeds all models and both horizons. With ``labels`` only those
    models run and only their partitions are replaced; without, those of models that are
    no longer in the roster go.
    """
    roster = cfg.models or FULL_ROSTER
    if labels is not None:
        roster = {label: roster[label] for label in labels}
    check_models(roster)
    arrays = durable(series.series_arrays(_read(spark, cfg, "split"), cfg))
    failures = []
    for horizon, table in (("test", "forecast_on_test"), ("full", "all_models_forecast")):
        forecasts, errors = forecast_with_errors(arrays, cfg, roster, horizon, errors=True)
        replace_partitions(forecasts, cfg.database, TableSpec.of(table), roster, drop_others=labels is None)
        failures.append(errors)
    # errors of models that did not run stay
    found = reduce(DataFrame.unionByName, failures).distinct()
    replace_partitions(found, cfg.database, TableSpec.of("model_errors"), roster, drop_others=labels is None)
    _log(spark, cfg, f"model[{','.join(roster)}]")


def build_evaluation(spark: SparkSession, cfg: Settings) -> None:
    """Forecasts of the roster's models to ``metrics``, ``best_models`` and the champions'
    ``forecast``."""
    of_roster = F.col("model").isin(list(cfg.models or FULL_ROSTER))
    split = _read(spark, cfg, "split")
    metrics = evaluate.forecast_metrics(
        split.filter(F.col("split") == "test"),
        _read(spark, cfg, "forecast_on_test").filter(of_roster),
        cfg,
        train=split.filter(F.col("split") == "train"),
    )
    _write(cfg, metrics, "metrics")
    _write(cfg, evaluate.best_models(_read(spark, cfg, "metrics"), cfg), "best_models")

    champions = _read(spark, cfg, "best_models")
    summary = evaluate.champion_mean_metric(champions).first()["value"]
    _log(spark, cfg, "evaluation", cfg.selection_metric, summary)
    ahead = _read(spark, cfg, "all_models_forecast").filter(of_roster)
    _write(cfg, evaluate.champion_forecast(ahead, champions, cfg), "forecast")


def build_output(spark: SparkSession, cfg: Settings) -> None:
    """``input`` and ``forecast`` to the published ``output``."""
    published = publish.publish_demand(
        _read(spark, cfg, "input"), _read(spark, cfg, "forecast"), cfg
    )
    _write(cfg, published, "output")
    _log(spark, cfg, "output")


STAGES = (
    prepare_catalog,
    ingest,
    build_input,
    build_split,
    build_forecasts,
    build_evaluation,
    build_output,
)


def run_workflow(spark: SparkSession, cfg: Settings) -> DataFrame:
    """All stages in order; returns the published table."""
    for stage in STAGES:
        stage(spark, cfg)
    return _read(spark, cfg, "output")


def published_demand(
    daily: DataFrame, cfg: Settings, roster: dict | None = None
) -> DataFrame:
    """From daily demand to published demand without tables."""
    daily = durable(daily)
    return publish.publish_demand(daily, champions_from(daily, cfg, roster), cfg)


def champions_from(daily: DataFrame, cfg: Settings, roster: dict | None = None) -> DataFrame:
    """Champions' forecasts from daily demand, written to the checkpoint folder.

    With closed-form models alone the metrics follow from the series rows where they are,
    and choosing and forecasting share their shuffle. Other models need forecasts of
    several kinds brought together, so the arrays are written once for all of them.
    """
    roster = roster or cfg.models or FULL_ROSTER
    arrays = series.series_arrays(series.prepare_series(daily, cfg), cfg)
    pairs = closed_form_pairs(arrays, cfg, roster)
    if pairs is None:
        arrays = durable(arrays)
        on_test = forecast_with_errors(arrays, cfg, roster, "test")[0]
        pairs = evaluate.paired_with_actuals(test_rows(arrays, cfg), on_test, cfg)
    train = train_rows(arrays, cfg)
    metrics = evaluate.score(pairs, cfg, [cfg.selection_metric], train)
    champions = evaluate.best_models(metrics, cfg)
    return durable(forecast_with_errors(arrays, cfg, roster, "full", champions)[0])


def train_rows(arrays: DataFrame, cfg: Settings) -> DataFrame:
    """Training days of the series arrays in long form."""
    seen = F.slice("y", 1, F.col("n_train"))
    return _days(arrays, cfg, F.col("first_day"), seen)


def test_rows(arrays: DataFrame, cfg: Settings) -> DataFrame:
    """Test days of the series arrays in long form."""
    held_out = F.slice("y", F.col("n_train") + 1, F.size("y"))
    return _days(arrays, cfg, F.date_add("first_day", F.col("n_train") * cfg.freq_days), held_out)


def _days(arrays: DataFrame, cfg: Settings, start: Column, values: Column) -> DataFrame:
    days = arrays.select(*cfg.groups, start.alias("_start"), F.posexplode(values).alias("_i", "_v"))
    when = F.date_add("_start", F.col("_i") * cfg.freq_days)
    return days.select(
        *cfg.groups, when.alias(cfg.time_column), F.col("_v").alias(cfg.target_column)
    )
