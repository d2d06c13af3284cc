"""The model roster: names, eligibility, and one pass that forecasts every series."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.config import Settings
from demandloom.durable import durable
from demandloom.models import changepoints, closed_form, plugin, pooled, winters

Builder = Callable[..., Column]


@dataclass(frozen=True)
class ClosedForm:
    build: Builder
    # fewest days of history, given the model's parameters
    min_points: Callable[[Mapping[str, Any]], int]
    # whether the model asks how many days a step is
    by_days: bool = False


CLOSED_FORM: dict[str, ClosedForm] = {
    "mean": ClosedForm(closed_form.mean_forecast, lambda p: 1),
    "moving_average": ClosedForm(closed_form.moving_average, lambda p: p.get("window", 7)),
    "croston": ClosedForm(closed_form.croston, lambda p: 1),
    "holt_winters": ClosedForm(
        winters.holt_winters, lambda p: 2 * p.get("period", 7) if p.get("seasonal", "additive") else 2
    ),
    "trend_seasonal": ClosedForm(closed_form.trend_seasonal, lambda p: 3),
    "changepoint_trend": ClosedForm(changepoints.changepoint_trend, lambda p: 2, by_days=True),
}

POOLED = {"random_forest": pooled.random_forest, "gbt": pooled.gbt}

# Model class names of configuration files, and the model that answers
# to each.
CLASS_NAMES: dict[str, str] = {
    "NaiveMean": "mean",
    "NaiveMovingAverage": "moving_average",
    "Croston": "croston",
    "ExponentialSmoothing": "holt_winters",
    "Prophet": "changepoint_trend",
    "RandomForest": "random_forest",
    "XGBModel": "gbt",
}

# Parameter names of configuration files, and ours.
PARAMETER_NAMES: dict[str, str] = {
    "input_chunk_length": "window",
    "seasonal_periods": "period",
    "random_state": "seed",
    "n_estimators": "trees",
    "max_depth": "depth",
    "learning_rate": "step_size",
    "eta": "step_size",
    "lambda": "l2",
    "reg_lambda": "l2",
    "reg_alpha": "l1",
    "min_split_loss": "gamma",
    "min_child_weight": "min_weight",
    "min_samples_leaf": "min_weight",
    "subsample": "row_share",
    "colsample_bytree": "column_share",
    "max_features": "column_share",
    "max_bin": "bins",
    "n_changepoints": "changepoints",
    "changepoint_prior_scale": "changepoint_prior",
    "seasonality_mode": "mode",
    "seasonality_prior_scale": "season_prior",
    "weekly_seasonality": "weekly",
    "yearly_seasonality": "yearly",
}
# names that mean something else in another model
OWN_NAMES: dict[str, dict[str, str]] = {"gbt": {"alpha": "l1"}}

# Library parameters that change no forecast; those that would, with the values
# that switch them off; and other spellings of values.
IGNORED = frozenset(
    ("n_jobs", "nthread", "verbosity", "verbose", "objective", "tree_method", "output_chunk_length", "seed")
)
WITHOUT_EFFECT: dict[str, tuple[Any, ...]] = {
    "daily_seasonality": (False, "auto", None),
    "holidays": (None,),
    "booster": ("gbtree", None),
    "colsample_bylevel": (1, None),
    "colsample_bynode": (1, None),
    "max_delta_step": (0, None),
    "scale_pos_weight": (1, None),
    "bootstrap": (True, None),
    "criterion": ("squared_error", None),
    "min_samples_split": (2, None),
    "max_leaf_nodes": (None,),
}
VALUE_NAMES = {"add": "additive", "mul": "multiplicative", "none": None}

# Parameters each model takes.
PARAMETERS: dict[str, tuple[str, ...]] = {
    "mean": (),
    "moving_average": ("window",),
    "croston": ("version", "alpha"),
    "holt_winters": ("period", "alpha", "beta", "gamma", "trend", "damped", "seasonal", "search"),
    "trend_seasonal": ("period",),
    "changepoint_trend": (
        "growth", "changepoints", "changepoint_range", "changepoint_prior", "mode", "season_prior", "weekly", "yearly", "noise",
    ),
    "random_forest": ("lags", "trees", "depth", "min_weight", "column_share", "bins", "seed"),
    "gbt": (
        "lags", "trees", "depth", "step_size", "l1", "l2", "gamma", "min_weight", "row_share", "column_share", "bins", "seed",
    ),
}

# Label -> model; labels break ties between equal metrics. The first roster has the models
# whose forecasts plain SQL can reproduce.
DEFAULT_ROSTER: dict[str, dict[str, Any]] = {
    "ExponentialSmoothing": {"model": "holt_winters", "params": {"period": 7, "search": "grid"}},
    "TrendSeasonal": {"model": "trend_seasonal", "params": {"period": 7}},
    "Croston": {"model": "croston", "params": {"version": "sba"}},
    "NaiveMean": {"model": "mean", "params": {}},
    "NaiveMovingAverage": {"model": "moving_average", "params": {"window": 7}},
}
FULL_ROSTER: dict[str, dict[str, Any]] = {
    "ExponentialSmoothing": {"model": "holt_winters", "params": {"period": 7}},
    "ChangepointTrend": {"model": "changepoint_trend", "params": {}},
    "GradientBoostedTrees": {
        "model": "gbt",
        "params": {"lags": 7, "depth": 6, "step_size": 0.3, "gamma": 0, "l2": 1, "l1": 0, "seed": 0},
    },
    "RandomForest": {
        "model": "random_forest",
        "params": {"lags": 7, "trees": 100, "depth": 6, "seed": 0},
    },
    "Croston": {"model": "croston", "params": {"version": "sba"}},
    "NaiveMean": {"model": "mean", "params": {}},
    "NaiveMovingAverage": {"model": "moving_average", "params": {"window": 7}},
}


def resolve(name: str) -> str:
    """Our model name for a model or class name; unknown names are an error."""
    model = CLASS_NAMES.get(name, name)
    if model not in CLOSED_FORM and model not in POOLED and model not in plugin.registered():
        known = ", ".join([*CLOSED_FORM, *POOLED, *CLASS_NAMES, *plugin.registered()])
        raise ValueError(f"unknown model {name!r}; known models: {known}")
    return model


def resolve_params(model: str, params: Mapping[str, Any] | None) -> dict[str, Any]:
    """The parameters a model takes, under our names; a plug-in's are its own.

    Names that only steer a library's machinery are left out. Those of mathematics that no
    method here has are left out with a warning, or without one at the value that switches
    them off; any other name is an error.
    """
    if model not in PARAMETERS:
        return dict(params or {})
    names = PARAMETER_NAMES | OWN_NAMES.get(model, {})
    taken: dict[str, Any] = {}
    unknown, lost = [], []
    for name, value in (params or {}).items():
        ours = names.get(name, name)
        if ours in PARAMETERS[model]:
            taken[ours] = VALUE_NAMES.get(value, value) if isinstance(value, str) else value
        elif name in WITHOUT_EFFECT:
            if value not in WITHOUT_EFFECT[name]:
                lost.append(name)
        elif ours not in IGNORED and name not in IGNORED:
            unknown.append(name)
    if unknown:
        raise ValueError(f"unknown parameters of {model}: {', '.join(sorted(unknown))}")
    if lost:
        warnings.warn(f"{model} has no {', '.join(sorted(lost))}: its forecasts do not depend on them", stacklevel=2)
    return taken


def check_models(roster: Mapping[str, Mapping[str, Any]]) -> None:
    """An error for any model, or parameter of one, that is not known."""
    for _ in _entries(roster):
        pass


def _entries(roster: Mapping[str, Mapping[str, Any]]):
    for label, entry in roster.items():
        model = resolve(entry["model"])
        yield label, model, resolve_params(model, entry.get("params"))


CHOSEN = "_chosen"

# Fixed value: why a forecast that is short or not finite does not count.
INCOMPLETE = "incomplete forecast"


def is_complete(path: Column, steps: int) -> Column:
    """A path counts only with a finite value for every step; null paths do not."""
    usable = F.forall(path, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(path) == steps) & usable, F.lit(False))


def history_of(
    series: DataFrame,
    cfg: Settings,
    horizon: str,
    champions: DataFrame | None = None,
    keep_all: bool = False,
) -> tuple[DataFrame, int]:
    """Series rows cut to what a horizon may see, and its number of steps.

    ``test`` sees the training days and forecasts the test days, ``full`` sees
    everything and forecasts the days from execution on. With champions, each series
    carries the one model that is to forecast it, and series without one are left out
    unless all are to be kept to learn from. ``_actual`` holds the days not seen.
    """
    if horizon == "test":
        seen, steps = F.slice("y", 1, F.col("n_train")), cfg.test_size
    elif horizon == "full":
        seen, steps = F.col("y"), cfg.steps
    else:
        raise ValueError(f"unknown horizon {horizon!r}: use 'test' or 'full'")
    unseen = F.slice("y", F.size(seen) + 1, F.size("y"))
    columns = [*cfg.groups, "first_day", seen.alias("y"), unseen.alias("_actual")]
    if champions is not None:
        chosen = champions.select(*cfg.groups, F.col("model").alias(CHOSEN))
        # inner, so that both sides drop null keys alike and can share one shuffle
        series = series.join(chosen, cfg.groups, "left" if keep_all else "inner")
        columns.append(CHOSEN)
    return series.select(*columns).filter(F.size("y") > 0), steps


def _is_for(known: DataFrame, label: str) -> Column:
    return F.col(CHOSEN) == label if CHOSEN in known.columns else F.lit(True)


def model_eligibility(
    series: DataFrame, cfg: Settings, roster: Mapping[str, Mapping[str, Any]], horizon: str = "test"
) -> DataFrame:
    """Per series and model: days of history seen, days needed, and whether it runs."""
    seen = F.col("n_train") if horizon == "test" else F.size("y")
    needs = [
        F.struct(F.lit(label).alias("model"), F.lit(_min_points(model, params)).alias("min_points"))
        for label, model, params in _entries(roster)
    ]
    return (
        series.select(*cfg.groups, seen.alias("points"), F.inline(F.array(*needs)))
        .withColumn("eligible", F.col("points") >= F.col("min_points"))
        .select("model", *cfg.groups, "points", "min_points", "eligible")
    )


def _min_points(model: str, params: Mapping[str, Any]) -> int:
    if model in CLOSED_FORM:
        return CLOSED_FORM[model].min_points(params)
    if model in POOLED:
        return params.get("lags", pooled.LAGS) + 1
    return 1


def closed_form_paths(
    known: DataFrame, cfg: Settings, steps: int, roster: Mapping[str, Mapping[str, Any]]
) -> DataFrame:
    """Every closed-form model of the roster in one pass over the series rows:
    (model, *groups, _actual, _start, _path)."""
    paths, models = [], []
    for i, (label, model, params) in enumerate(_entries(roster)):
        spec = CLOSED_FORM[model]
        runs = (F.size("y") >= spec.min_points(params)) & _is_for(known, label)
        history = F.when(runs, F.col("y"))
        given = params | {"freq_days": cfg.freq_days} if spec.by_days else params
        paths.append(F.when(runs, spec.build(history, steps, **given)).alias(f"_path_{i}"))
        models.append(F.struct(F.lit(label).alias("model"), F.col(f"_path_{i}").alias("_path")))
    start = F.date_add("first_day", F.size("y") * cfg.freq_days).alias("_start")
    return known.select(*cfg.groups, "_actual", start, *paths).select(
        *cfg.groups, "_actual", "_start", F.inline(F.array(*models))
    )


def closed_form_pairs(
    series: DataFrame, cfg: Settings, roster: Mapping[str, Mapping[str, Any]]
) -> DataFrame | None:
    """Test days with their forecasts, (model, *groups, target, prediction), paired inside
    the series row without a join; None if the roster has other models as well."""
    if any(model not in CLOSED_FORM for _, model, _ in _entries(roster)):
        return None
    known, steps = history_of(series, cfg, "test")
    target = cfg.target_column
    paired = F.zip_with(
        "_actual", "_path", lambda y, p: F.struct(y.alias(target), p.alias("prediction"))
    )
    paths = closed_form_paths(known, cfg, steps, roster).filter(is_complete(F.col("_path"), steps))
    pairs = paths.select("model", *cfg.groups, F.inline(paired))
    return pairs.filter(F.col(target).isNotNull() & F.col("prediction").isNotNull())


def unroll(paths: DataFrame, cfg: Settings, steps: int) -> DataFrame:
    """One row per forecast day of the complete paths of (model, groups, _start, _path)."""
    days = paths.filter(is_complete(F.col("_path"), steps)).select(
        "model", *cfg.groups, "_start", F.posexplode("_path").alias("_step", cfg.target_column)
    )
    when = F.date_add("_start", F.col("_step") * cfg.freq_days)
    return days.select("model", *cfg.groups, when.alias(cfg.time_column), cfg.target_column)


def incomplete(paths: DataFrame, cfg: Settings, steps: int) -> DataFrame:
    """One error row per path that a model gave and that does not count."""
    given = F.col("_path").isNotNull() & ~is_complete(F.col("_path"), steps)
    return paths.filter(given).select("model", *cfg.groups, F.lit(INCOMPLETE).alias("error"))


def forecast_series(
    series: DataFrame, cfg: Settings, roster: Mapping[str, Mapping[str, Any]], horizon: str
) -> DataFrame:
    """Forecasts of the whole roster in long form: (model, *groups, time, target).

    A series a model cannot forecast has no rows for that model.
    """
    return forecast_with_errors(series, cfg, roster, horizon)[0]


def forecast_with_errors(
    series: DataFrame,
    cfg: Settings,
    roster: Mapping[str, Mapping[str, Any]],
    horizon: str,
    champions: DataFrame | None = None,
    errors: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """Forecasts, and one row per series and model that failed or gave no complete path
    (None unless asked for; the paths are then written once for both).

    With champions a series is forecast by its own champion alone, which gives the rows
    that choosing from all models' forecasts would. Pooled models still learn from every
    series, and are fitted only if some series chose them.
    """
    entries = list(_entries(roster))
    chosen = None
    if champions is not None and any(model in POOLED for _, model, _ in entries):
        # one row per model of the roster
        chosen = {row["model"] for row in champions.select("model").distinct().collect()}
    runs = [e for e in entries if chosen is None or e[1] not in POOLED or e[0] in chosen]
    learns = any(model in POOLED for _, model, _ in runs)
    known, steps = history_of(series, cfg, horizon, champions, keep_all=learns)
    direct = {label: roster[label] for label, model, _ in runs if model in CLOSED_FORM}
    parts, failures = [], []

    def add(paths: DataFrame) -> None:
        if errors:
            paths = durable(paths)
            failures.append(incomplete(paths, cfg, steps))
        parts.append(unroll(paths, cfg, steps))

    if direct:
        add(closed_form_paths(known, cfg, steps, direct).drop("_actual"))
    for label, model, params in runs:
        wanted = _is_for(known, label)
        if model in POOLED:
            add(POOLED[model](known, cfg, steps, label, wanted=wanted, **params))
        elif model not in CLOSED_FORM:
            ran = known.filter(wanted)
            if errors:
                done, failed = plugin.plugin_forecast(ran, cfg, steps, label, model, params)
                failures.append(failed)
            else:
                done = plugin.plugin_forecast_only(ran, cfg, steps, label, model, params)
            parts.append(done)
    if not entries:
        raise ValueError("the roster has no models")
    if not parts:
        empty = known.select(
            F.lit("").alias("model"), *cfg.groups,
            F.col("first_day").alias(cfg.time_column), F.lit(0.0).alias(cfg.target_column),
        )
        parts.append(empty.limit(0))
    return reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, failures) if failures else None
