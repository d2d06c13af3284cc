"""Every registered query: (spark, folder of the test tables) -> DataFrame.

Values are rounded at the very end only, so that sums taken in another order by
another engine still compare equal.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.durable import durable
from demandloom.functions.casts import lenient_double
from demandloom.functions.metrics import PandasMetric
from demandloom.models import plugin, pooled, roster, trees, winters
from demandloom.operators import classify, demand, evaluate, publish, quality, reports, series
from demandloom.operators.ranges import measure_ranges
from demandloom.plans import fixtures as fx
from demandloom.plans import oracles, workflow

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CFG = fx.EVENTS

# Models whose forecasts plain SQL can reproduce, and all models.
CLOSED_FORM = roster.DEFAULT_ROSTER
FULL = roster.FULL_ROSTER
EXTENDED = ("mae", "mse", "rmse", "mape", "mape_pct", "wmape", "smape", "bias", "r2", "rmsle", "mase",
            "r2_score", "marre", "ope", "coefficient_of_variation", "rmsse")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def both_rosters(function: Callable) -> Callable:
    """A query over all models under its own name, and one over the closed-form models, whose
    rows SQL can give, under that name and ``_closed_form``."""

    def over(models):
        return lambda spark, d: function(spark, d, models)

    QUERIES[function.__name__] = over(FULL)
    QUERIES[f"{function.__name__}_closed_form"] = over(CLOSED_FORM)
    return function


_SHARED: dict[tuple[str, str, str], DataFrame] = {}


def shared(spark: SparkSession, d: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What several queries of one session start from, made once: learners are fitted once for
    all reports on them."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _SHARED:
        _SHARED[key] = durable(build())
    return _SHARED[key]


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# ---- shared inputs -------------------------------------------------------------


def _located(spark, d):
    return demand.zip_to_city(fx.sales(spark, d), fx.geo(spark, d))


def _split(spark, d):
    return series.prepare_series(fx.demand(spark, d), CFG)


def _arrays(spark, d):
    return series.series_arrays(_split(spark, d), CFG)


def _filled(spark, d):
    return series.gap_fill(series.history_window(fx.demand(spark, d), CFG), CFG)


def _forecasts(spark, d, models, horizon):
    """Series arrays and the roster's forecasts for a horizon."""
    arrays = _arrays(spark, d)
    if models is CLOSED_FORM:
        arrays = durable(arrays)
        return arrays, roster.forecast_series(arrays, CFG, models, horizon)
    arrays = shared(spark, d, "arrays", lambda: arrays)
    return arrays, shared(spark, d, horizon, lambda: roster.forecast_series(arrays, CFG, models, horizon))


def _scored(spark, d, models, metrics=None):
    """Series arrays, test rows, test forecasts and metrics, from forecasts made once."""
    arrays, on_test = _forecasts(spark, d, models, "test")
    on_test = durable(on_test)
    actual = workflow.test_rows(arrays, CFG)
    return arrays, actual, on_test, evaluate.forecast_metrics(actual, on_test, CFG, metrics)


def _cold(spark, d, models):
    """Demand, champions' forecasts and rolling sums with two cities never forecast."""
    if models is CLOSED_FORM:
        daily = durable(fx.cold_start_demand(spark, d))
        forecast = workflow.champions_from(daily, CFG, models)
    else:
        daily = shared(spark, d, "cold", lambda: fx.cold_start_demand(spark, d))
        forecast = shared(spark, d, "cold champions", lambda: workflow.champions_from(daily, CFG, models))
    return daily, publish.weekly_forecast(forecast, CFG)


# ---- demand ----------------------------------------------------------------------


@query
def daily_demand(spark, d):
    return rounded(fx.demand(spark, d), "sales")


@query
def zip_to_city(spark, d):
    return _located(spark, d)


def _beyond_broadcast(spark, d):
    """The range table as one too large to send to every task."""
    return measure_ranges(fx.geo(spark, d), broadcast_rows=0)


@query
def zip_to_city_large_ranges(spark, d):
    return demand.zip_to_city(fx.sales(spark, d), _beyond_broadcast(spark, d))


@query
def daily_demand_large_ranges(spark, d):
    return rounded(demand.daily_demand(fx.sales(spark, d), _beyond_broadcast(spark, d)), "sales")


@query
def zip_to_city_overlapping(spark, d):
    return demand.zip_to_city(fx.sales(spark, d), fx.overlapping_geo(spark, d))


@query
def zip_lookup_first_match(spark, d):
    return demand.first_city(fx.sales(spark, d), fx.overlapping_geo(spark, d))


@query
def city_filter(spark, d):
    return demand.keep_cities(fx.geo(spark, d), ["NATION_0", "NATION_1", "NATION_7"])


@query
def orders_daily_demand(spark, d):
    return rounded(fx.orders_demand(spark, d), "sales")


# ---- data quality ------------------------------------------------------------------


@query
def junk_sales_values(spark, d):
    return quality.junk_values(fx.sales(spark, d))


@query
def sales_by_weekday(spark, d):
    return rounded(quality.sales_by_weekday(_located(spark, d)), "sales")


@query
def value_frequency(spark, d):
    return rounded(quality.value_frequency(_located(spark, d)), "percentage", digits=2)


@query
def cap_share_weekday(spark, d):
    return rounded(quality.cap_share(_located(spark, d), ["weekday"], zero_when_absent=False), "share")


@query
def cap_share_city(spark, d):
    return rounded(quality.cap_share(_located(spark, d), ["city"], zero_when_absent=False), "share")


@query
def cap_share_zipcode(spark, d):
    return rounded(quality.cap_share(_located(spark, d), ["zipcode"]), "share")


@query
def cap_share_product(spark, d):
    return rounded(quality.cap_share(_located(spark, d), ["product_id"]), "share")


@query
def cap_share_series(spark, d):
    share = quality.cap_share(_located(spark, d), ["city", "product_id"], of_values=True)
    return rounded(share, "share")


@query
def capped_keys(spark, d):
    key_sets = (["zipcode"], ["product_id"], ["city", "product_id"])
    return quality.capped_keys(_located(spark, d), key_sets)


@query
def unmatched_share(spark, d):
    return quality.unmatched_share(demand.first_city(fx.sales(spark, d), fx.geo(spark, d)))


@query
def series_coverage(spark, d):
    return quality.series_coverage(fx.sales(spark, d), fx.geo(spark, d), _located(spark, d))


@query
def profile_columns(spark, d):
    return quality.profile_columns(fx.sales(spark, d))


@query
def profile_geo(spark, d):
    return quality.profile_columns(fx.geo(spark, d))


@query
def numeric_profile(spark, d):
    return rounded(quality.numeric_profile(fx.demand(spark, d)), "mean", "std", digits=4)


def _sketched(spark, d):
    """Sketches of two halves of the sales, merged, and the located sales they are of."""
    sold = _located(spark, d).withColumn("sales", lenient_double(F.col("sales")))
    halves = [quality.profile_sketches(sold.where(F.weekday("date") % 2 == k)) for k in (0, 1)]
    return sold, quality.sketched_profile(quality.merge_sketches(halves[0].unionByName(halves[1])))


@query
def sketched_quantiles(spark, d):
    """Whether the share of values up to each quantile found is the one asked for."""
    sold, profile = _sketched(spark, d)
    found = profile.where("quantile is not null").select("column", "quantile", "value")
    long = sold.select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in ("zipcode", "sales")
    )))).where("v is not null and not isnan(v)")
    ranks = long.join(F.broadcast(found), "column").groupBy("column", "quantile").agg(
        F.avg((F.col("v") < F.col("value")).cast("double")).alias("below"),
        F.avg((F.col("v") <= F.col("value")).cast("double")).alias("upto"),
    )
    error = quality.RANK_ERROR
    near = (F.col("below") <= F.col("quantile") + error) & (F.col("upto") >= F.col("quantile") - error)
    return ranks.select("column", "quantile", near.alias("near"))


@query
def sketched_columns(spark, d):
    """Rows and missing values, and whether the distinct count is near the exact one."""
    sold, profile = _sketched(spark, d)
    exact = quality.profile_columns(sold).select("column", F.col("distinct").alias("exact"))
    near = F.abs(F.col("distinct") - F.col("exact")) <= quality.DISTINCT_ERROR * F.col("exact")
    return profile.select("column", "rows", "missing", "distinct").distinct().join(exact, "column").select(
        "column", "rows", "missing", near.alias("near")
    )


@query
def correlations(spark, d):
    return rounded(quality.correlations(fx.table(spark, d, "lineitem"), _MEASURES), "value")


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query
def duplicate_rate(spark, d):
    return quality.duplicate_rate(fx.sales(spark, d))


@query
def duplicate_rate_of_keys(spark, d):
    # transactions without their row id repeat, as in a feed of single sales
    return quality.duplicate_rate(fx.sales(spark, d).select("country", "product_id", "date"))


# ---- series ------------------------------------------------------------------------


@query
def history_window(spark, d):
    cfg = replace(CFG, time_delta=14)
    return rounded(series.history_window(fx.demand(spark, d), cfg), "sales")


@query
def gap_fill(spark, d):
    return rounded(_filled(spark, d), "sales")


@query
def gap_fill_global(spark, d):
    return rounded(series.gap_fill_global(fx.demand(spark, d), CFG), "sales")


@query
def gap_fill_sparse(spark, d):
    window = series.history_window(fx.orders_demand(spark, d), fx.ORDERS)
    return rounded(series.gap_fill(window, fx.ORDERS), "sales")


@query
def train_test_split(spark, d):
    return rounded(_split(spark, d), "sales")


@query
def series_arrays(spark, d):
    arrays = _arrays(spark, d)
    days = arrays.select("city", "product_id", "first_day", "n_train", F.posexplode("y").alias("pos", "sales"))
    return rounded(days.withColumn("pos", F.col("pos").cast("long")), "sales").withColumn(
        "n_train", F.col("n_train").cast("long")
    )


@query
def series_count(spark, d):
    return series.series_count(fx.demand(spark, d), CFG)


def _classes(df):
    return rounded(df, "adi", "cv2", digits=10)


@query
def demand_classes(spark, d):
    return _classes(classify.demand_classes(_filled(spark, d), CFG))


@query
def demand_classes_sparse(spark, d):
    window = series.history_window(fx.orders_demand(spark, d), fx.ORDERS)
    return _classes(classify.demand_classes(series.gap_fill(window, fx.ORDERS), fx.ORDERS))


@query
def class_distribution(spark, d):
    return classify.class_distribution(classify.demand_classes(_filled(spark, d), CFG))


@query
def class_samples(spark, d):
    filled = durable(_filled(spark, d))
    sample = classify.class_samples(filled, classify.demand_classes(filled, CFG), CFG)
    return rounded(sample, "sales", "adi", "cv2")


@query
def erratic_series(spark, d):
    filled = durable(_filled(spark, d))
    rows = classify.class_samples(
        filled, classify.demand_classes(filled, CFG), CFG, per_class=None, only="erratic"
    )
    return rounded(rows, "sales", "adi", "cv2")


# ---- forecasts -----------------------------------------------------------------------


def _single(name: str, **params):
    def run(spark, d):
        entry = {name: {"model": name, "params": params}}
        return rounded(roster.forecast_series(_arrays(spark, d), CFG, entry, "full"), "sales")

    return run


QUERIES["forecast_mean"] = _single("mean")
QUERIES["forecast_moving_average"] = _single("moving_average", window=7)
QUERIES["forecast_croston_sba"] = _single("croston", version="sba")
QUERIES["forecast_croston_classic"] = _single("croston", version="classic")
QUERIES["forecast_holt_winters"] = _single("holt_winters", period=7, alpha=0.3, beta=0.1, gamma=0.2)
QUERIES["forecast_holt_winters_grid"] = _single("holt_winters", period=7, search="grid")
QUERIES["forecast_holt_winters_fitted"] = _single("holt_winters", period=7)
QUERIES["forecast_trend_seasonal"] = _single("trend_seasonal", period=7)
QUERIES["forecast_changepoint_trend"] = _single("changepoint_trend")
# one changepoint, no season, and a given noise: three equations
QUERIES["forecast_one_changepoint"] = _single("changepoint_trend", changepoints=1, weekly=False, yearly=False, noise=0.05)


def _learner(name: str, label: str):
    def run(spark, d):
        # the model is fitted once for all reports on the roster
        found = _forecasts(spark, d, FULL, "full")[1].filter(F.col("model") == label)
        return found.withColumn("model", F.lit(name))

    QUERIES[f"forecast_{name}"] = lambda spark, d: rounded(run(spark, d), "sales")
    return run


_random_forest = _learner("random_forest", "RandomForest")
_gbt = _learner("gbt", "GradientBoostedTrees")


def _splits(spark, d, boosted, **growth):
    known, _ = roster.history_of(_arrays(spark, d), CFG, "full")
    model = pooled.fit(known, CFG, pooled.LAGS, trees.Growth(**growth), boosted)
    return rounded(pooled.tree_table(known, model), "gain", digits=4)


@query
def boosted_first_tree(spark, d):
    return _splits(spark, d, True, trees=1, depth=2, step=0.3, l1=0.5, l2=1.0, gamma=0.01, seed=0)


@query
def forest_first_splits(spark, d):
    return _splits(spark, d, False, trees=oracles.BAGS, depth=1, seed=0)


@query
def holt_winters_fit_error(spark, d):
    """Whether the searched parameters leave no larger error than the grid's best."""
    known, _ = roster.history_of(_arrays(spark, d), CFG, "full")
    errors = known.select(
        *CFG.groups, winters.in_sample_error(F.col("y")).alias("fit"), winters.in_sample_error(F.col("y"), "grid").alias("grid")
    )
    return errors.select(*CFG.groups, (F.col("fit") <= F.col("grid")).alias("not_worse"))


@query
def forecast_croston_sparse(spark, d):
    split = series.prepare_series(fx.orders_demand(spark, d), fx.ORDERS)
    arrays = series.series_arrays(split, fx.ORDERS)
    entry = {"croston": {"model": "croston", "params": {"version": "sba"}}}
    return rounded(roster.forecast_series(arrays, fx.ORDERS, entry, "full"), "sales")


@query
def forecast_plugin_naive(spark, d):
    known, steps = roster.history_of(_arrays(spark, d), CFG, "full")
    naive = plugin.plugin_forecast_only(known, CFG, steps, "last_value", "last_value")
    return rounded(naive, "sales")


def _drift():
    # built in here, it travels to the executors by value
    class Drift:
        """A model in class form: the mean of the series, and ``by``."""

        def __init__(self, by=0.0):
            self.by = by

        def fit(self, series):
            self.level = series.mean()

        def predict(self, n):
            return [self.level + self.by] * n

    return Drift


def _patchy():
    # built in here, it travels to the executors by value
    def patchy(pdf, steps):
        """The last value carried forward, spoilt in three of four cities."""
        days = [pdf["date"].iloc[-1] + timedelta(days=k) for k in range(1, steps + 1)]
        found = pd.DataFrame({"date": days, "sales": float(pdf["sales"].iloc[-1])})
        kind = int(pdf["city"].iloc[0].split("_")[1]) % 4
        if kind == 1:
            found.loc[0, "sales"] = float("nan")
        elif kind == 2:
            found = found.iloc[1:]
        elif kind == 3:
            found["date"] = [day + timedelta(days=1) for day in days]
        return found

    return patchy


plugin.register_model("patchy", _patchy())


@query
def forecast_plugin_class(spark, d):
    plugin.register_class("drift", _drift())
    known, steps = roster.history_of(_arrays(spark, d), CFG, "full")
    found = plugin.plugin_forecast_only(known, CFG, steps, "drift", "drift", {"by": 2.0})
    return rounded(found, "sales")


@query
def model_failures(spark, d):
    models = {"Patchy": {"model": "patchy"}, "NaiveMean": {"model": "mean"}}
    arrays = durable(_arrays(spark, d))
    found, errors = roster.forecast_with_errors(arrays, CFG, models, "test", errors=True)
    metrics = evaluate.forecast_metrics(workflow.test_rows(arrays, CFG), found, CFG, ["mae"])
    champions = evaluate.best_models(metrics, CFG).withColumnRenamed("metric", "detail")
    columns = ("model", "city", "product_id", "detail")
    return (
        errors.withColumnRenamed("error", "detail").select(F.lit("error").alias("kind"), *columns)
        .unionByName(champions.select(F.lit("champion").alias("kind"), *columns))
    )


@query
def pooled_training_rows(spark, d):
    known, _ = roster.history_of(_arrays(spark, d), CFG, "full")
    rows = pooled.training_rows(pooled.scaled_series(known, CFG, pooled.LAGS), CFG, pooled.LAGS)
    values = F.col("features")
    return rows.select(
        *(F.round(values[pooled.LAGS - k], 6).alias(f"lag_{k}") for k in range(1, pooled.LAGS + 1)),
        values[pooled.LAGS].cast("long").alias("weekday"), F.round("label", 6).alias("label"), "key",
    )


@query
def forecast_random_forest_bounds(spark, d):
    """Days forecast, and whether each value lies between the smallest and the largest share
    of a mean that a forest of averages can give."""
    found = _random_forest(spark, d)
    known, _ = roster.history_of(_arrays(spark, d), CFG, "full")
    scaled = pooled.scaled_series(known, CFG, pooled.LAGS)
    # one row
    ends = pooled.training_rows(scaled, CFG, pooled.LAGS).agg(F.min("label").alias("low"), F.max("label").alias("high")).first()
    share = F.col("sales") / F.col("_scale")
    within = (share >= ends["low"] - 1e-9) & (share <= ends["high"] + 1e-9)
    return found.join(scaled.select(*CFG.groups, "_scale"), CFG.groups).select(
        "model", *CFG.groups, "date", within.alias("within")
    )


@query
def forecast_gbt_days(spark, d):
    finite = F.col("sales").isNotNull() & ~F.isnan("sales") & (F.abs("sales") < float("inf"))
    return _gbt(spark, d).select("model", *CFG.groups, "date", finite.alias("finite"))


@query
def lag_features(spark, d):
    lags = pooled.lag_features(_filled(spark, d), CFG)
    columns = ["sales", *(f"lag_{k}" for k in range(1, 8))]
    return rounded(lags.withColumn("weekday", F.col("weekday").cast("long")), *columns)


@query
def model_eligibility(spark, d):
    daily = fx.cold_start_demand(spark, d)
    arrays = series.series_arrays(series.prepare_series(daily, CFG), CFG)
    table = roster.model_eligibility(arrays, CFG, roster.FULL_ROSTER, "test")
    return table.withColumns({c: F.col(c).cast("long") for c in ("points", "min_points")})


@both_rosters
def model_forecasts(spark, d, models):
    return rounded(_forecasts(spark, d, models, "full")[1], "sales")


@both_rosters
def forecasts_on_test(spark, d, models):
    return rounded(_forecasts(spark, d, models, "test")[1], "sales")


# ---- evaluation ----------------------------------------------------------------------


@both_rosters
def forecast_metrics(spark, d, models):
    return rounded(_scored(spark, d, models, ["rmse", "mae", "mape"])[3], "value")


@both_rosters
def extended_metrics(spark, d, models):
    arrays, on_test = _forecasts(spark, d, models, "test")
    scored = evaluate.forecast_metrics(
        workflow.test_rows(arrays, CFG),
        on_test,
        CFG,
        EXTENDED,
        train=workflow.train_rows(arrays, CFG),
    )
    # squares of sums are large: keep fewer digits of them
    digits = F.when(F.col("metric") == "mse", F.round("value", 2)).otherwise(F.round("value", 6))
    return scored.withColumn("value", digits)


def _worst_day():
    # built in here, it travels to the executors by value
    def worst_day(actual, predicted):
        """A user metric over two pandas series."""
        return (actual - predicted).abs().max()

    return worst_day


def total_miss(actual, predicted):
    """A user metric over two columns."""
    return F.abs(F.sum(actual - predicted))


@both_rosters
def user_metrics(spark, d, models):
    return rounded(_scored(spark, d, models, [PandasMetric(_worst_day()), total_miss])[3], "value")


@both_rosters
def best_models(spark, d, models):
    return rounded(evaluate.best_models(_scored(spark, d, models)[3], CFG), "value")


@both_rosters
def champion_forecast(spark, d, models):
    metrics = _scored(spark, d, models, ["mae"])[3]
    champions = evaluate.best_models(metrics, CFG)
    ahead = _forecasts(spark, d, models, "full")[1]
    return rounded(evaluate.champion_forecast(ahead, champions, CFG), "sales")


@both_rosters
def champion_mean_metric(spark, d, models):
    champions = evaluate.best_models(_scored(spark, d, models, ["mae"])[3], CFG)
    return rounded(evaluate.champion_mean_metric(champions), "value")


@both_rosters
def metric_summary(spark, d, models):
    scored = _scored(spark, d, models, ["mae"])[3]
    return rounded(evaluate.metric_summary(scored), "median", "mean")


# ---- publishing ----------------------------------------------------------------------


@both_rosters
def weekly_forecast(spark, d, models):
    return rounded(_cold(spark, d, models)[1], "sales")


@both_rosters
def output_periods(spark, d, models):
    return publish.output_periods(_cold(spark, d, models)[1], CFG)


@both_rosters
def unforecast_series(spark, d, models):
    return publish.unforecast_series(*_cold(spark, d, models), CFG)


@both_rosters
def fallback_forecast(spark, d, models):
    return rounded(publish.fallback_forecast(*_cold(spark, d, models), CFG), "sales")


@both_rosters
def demand_output(spark, d, models):
    daily, weekly = _cold(spark, d, models)
    fallback = publish.fallback_forecast(daily, weekly, CFG)
    return rounded(publish.demand_output(weekly, fallback, CFG), "sales")


@both_rosters
def output_by_date(spark, d, models):
    daily, weekly = _cold(spark, d, models)
    fallback = publish.fallback_forecast(daily, weekly, CFG)
    output = publish.demand_output(weekly, fallback, CFG)
    return rounded(reports.volume_by(output, ["date"], CFG), "sales", digits=4)


@query
def published_demand_closed_form(spark, d):
    return rounded(workflow.published_demand(fx.demand(spark, d), CFG, CLOSED_FORM), "sales")


def _published(spark, d):
    return shared(spark, d, "published", lambda: workflow.published_demand(fx.demand(spark, d), CFG, FULL))


@query
def published_demand(spark, d):
    return rounded(_published(spark, d), "sales")


@query
def published_demand_all_models(spark, d):
    # what SQL can say of a roster with learners: which series and days are published
    usable = F.col("sales").isNotNull() & ~F.isnan("sales") & (F.col("sales") >= 0)
    return _published(spark, d).select("city", "product_id", "date", usable.alias("usable"))


# ---- reports -------------------------------------------------------------------------


@both_rosters
def metrics_with_champion(spark, d, models):
    scored = _scored(spark, d, models)[3]
    report = reports.metrics_with_champion(scored, evaluate.best_models(scored, CFG), "mae")
    return rounded(report, "value")


def _comparison(spark, d, models):
    arrays, actual, on_test, metrics = _scored(spark, d, models, ["mae"])
    labelled = actual.withColumn("split", F.lit("test"))
    champions = evaluate.best_models(metrics, CFG)
    return reports.champion_vs_actual(on_test, champions, labelled, CFG)


@both_rosters
def champion_vs_actual(spark, d, models):
    return rounded(_comparison(spark, d, models), "sales")


@both_rosters
def volume_by_model(spark, d, models):
    return rounded(reports.volume_by(_comparison(spark, d, models), ["model"], CFG), "sales", digits=4)


@both_rosters
def volume_by_model_date(spark, d, models):
    return rounded(reports.volume_by(_comparison(spark, d, models), ["model", "date"], CFG), "sales", digits=4)


@query
def largest_sales(spark, d):
    days = rounded(fx.demand(spark, d), "sales")
    return reports.head(days, 10, F.desc("sales"), "city", "product_id", "date")


@query
def ordered_diff(spark, d):
    """One city's days the other way round: the same rows, in another order."""
    days = rounded(fx.demand(spark, d), "sales")
    turned = F.when(F.col("city") == "NATION_1", F.date_diff(F.lit(CFG.execution_date), "date")).otherwise(
        F.date_diff("date", F.lit(CFG.start_date))
    )
    found = reports.ordered_diff(
        days.orderBy("city", "product_id", "date"), days.orderBy("city", "product_id", turned)
    )
    return found.withColumnRenamed(reports.POSITION, "position")


@query
def table_diff(spark, d):
    return rounded(
        reports.table_diff(
            rounded(fx.cold_start_demand(spark, d), "sales"), rounded(fx.demand(spark, d), "sales")
        ),
        "sales",
    )
