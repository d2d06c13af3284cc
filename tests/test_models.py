import random
from dataclasses import replace
from datetime import timedelta

import pandas as pd
import pytest
from helpers import CFG, P1, day, days, dense, inputs, values
from pyspark.sql import functions as F

from demandloom.models import closed_form, plugin, pooled, roster, winters
from demandloom.operators import evaluate, series
from demandloom.plans import workflow


def fold(spark, ys, build):
    df = spark.createDataFrame([(list(map(float, ys)),)], "y array<double>")
    return df.select(build(F.col("y")).alias("p")).first()["p"]


def arrays(spark, rows, cfg=CFG):
    return series.series_arrays(series.prepare_series(inputs(spark, rows), cfg), cfg)


def test_mean(spark):
    assert fold(spark, [1, 2, 6], lambda y: closed_form.mean_forecast(y, 2)) == [3.0, 3.0]


def test_moving_average_feeds_on_its_own_steps(spark):
    path = fold(spark, [1, 2, 3, 4], lambda y: closed_form.moving_average(y, 3, window=2))
    assert path == [3.5, 3.75, 3.625]


def test_croston(spark):
    sba = fold(spark, [0, 3, 0, 0, 5, 2], lambda y: closed_form.croston(y, 2))
    assert sba == pytest.approx([1.4703517587939696] * 2)
    classic = fold(spark, [0, 3, 0, 0, 5, 2], lambda y: closed_form.croston(y, 1, version="classic"))
    assert classic[0] * 0.95 == pytest.approx(sba[0])
    assert fold(spark, [0, 0, 0], lambda y: closed_form.croston(y, 2)) == [0.0, 0.0]
    with pytest.raises(ValueError):
        closed_form.croston(F.col("y"), 1, version="other")


def winters_by_hand(y, steps, m, a, b, g):
    level = sum(y[:m]) / m
    trend = (sum(y[m : 2 * m]) / m - level) / m
    season = [v - level for v in y[:m]]
    error = 0.0
    for t in range(m, len(y)):
        old = season[t % m]
        error += (y[t] - level - trend - old) ** 2
        before = level
        level = a * (y[t] - old) + (1 - a) * (level + trend)
        trend = b * (level - before) + (1 - b) * trend
        season[t % m] = g * (y[t] - level) + (1 - g) * old
    n = len(y)
    return error, [level + (h + 1) * trend + season[(n + h) % m] for h in range(steps)]


def test_holt_winters_against_the_recursion(spark):
    rng = random.Random(5)
    history = [[float(rng.randint(0, 20)) for _ in range(n)] for n in (14, 15, 20, 33, 13, 68)]
    df = spark.createDataFrame([(i, y) for i, y in enumerate(history)], "i int, y array<double>")
    fixed = df.select("i", winters.holt_winters(F.col("y"), 9, 7, 0.3, 0.1, 0.2).alias("p"))
    grid = df.select("i", winters.holt_winters(F.col("y"), 9, 7, search="grid").alias("p"))
    for frame, sets in ((fixed, [(0.3, 0.1, 0.2)]), (grid, winters.GRID)):
        for i, path in values(frame):
            if len(history[i]) < 14:
                assert path is None
                continue
            best = min((winters_by_hand(history[i], 9, 7, *p) for p in sets), key=lambda r: r[0])
            assert path == pytest.approx(best[1])


def smooth_by_hand(y, steps, m, a, b, g, phi=1.0, trend=True, seasonal="additive"):
    """Error and forecast by the textbook's recursion."""
    m = m if seasonal else 1
    level = sum(y[:m]) / m
    slope = (sum(y[m : 2 * m]) / m - level) / m if trend else 0.0
    factor = seasonal == "multiplicative"
    season = [v / level for v in y[:m]] if factor else [v - level for v in y[:m]]
    error = 0.0
    for t in range(m, len(y)):
        old, base = season[t % m], level + phi * slope
        error += (y[t] - (base * old if factor else base + old)) ** 2
        level = a * (y[t] / old if factor else y[t] - old) + (1 - a) * base
        slope = phi * slope + b * (level - base) if trend else 0.0
        season[t % m] = g * (y[t] / level if factor else y[t] - level) + (1 - g) * old
    ahead, grown = [], 0.0
    for h in range(1, steps + 1):
        grown += phi**h
        line, slot = level + grown * slope, season[(len(y) + h - 1) % m]
        ahead.append(line * slot if factor else line + slot)
    return error, ahead


@pytest.mark.parametrize(
    "parts",
    [{"damped": True}, {"seasonal": "multiplicative"}, {"seasonal": None}, {"trend": None}, {"trend": None, "seasonal": None},
     {"damped": True, "seasonal": "multiplicative"}],
)
def test_parts_of_smoothing_against_the_recursion(spark, parts):
    rng = random.Random(5)
    history = [[float(rng.randint(5, 20)) for _ in range(n)] for n in (14, 20, 33, 68)]
    df = spark.createDataFrame([(i, y) for i, y in enumerate(history)], "i int, y array<double>")
    seasonal, trend = parts.get("seasonal", "additive"), parts.get("trend", "additive")
    found = df.select("i", winters.holt_winters(F.col("y"), 9, 7, 0.3, 0.1, 0.2, **parts).alias("p"))
    for i, path in values(found):
        phi = winters.DAMPING if parts.get("damped") else 1.0
        g = 0.2 if seasonal else 0.0
        assert path == pytest.approx(smooth_by_hand(history[i], 9, 7, 0.3, 0.1, g, phi, bool(trend), seasonal)[1])


def test_fitted_smoothing_is_near_a_dense_grid_and_never_above_the_small_one(spark):
    rng = random.Random(8)
    history = [[30 + 0.4 * t + 6 * (t % 7) + rng.gauss(0, s) for t in range(n)] for n, s in ((60, 1), (45, 5), (68, 12))]
    df = spark.createDataFrame([(i, y) for i, y in enumerate(history)], "i int, y array<double>")
    errors = df.select("i", winters.in_sample_error(F.col("y")).alias("f"), winters.in_sample_error(F.col("y"), "grid").alias("g"))
    dense_grid = [0.001, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.8, 0.999]
    for i, fit, grid in values(errors):
        best = min(smooth_by_hand(history[i], 1, 7, a, b, g)[0] for a in dense_grid for b in dense_grid for g in dense_grid)
        assert fit <= grid and fit <= best * 1.01
    short = spark.createDataFrame([([1.0] * 13,), (None,)], "y array<double>")
    assert values(short.select(winters.in_sample_error(F.col("y")))) == [(None,), (None,)]


def test_season_as_a_factor_needs_positive_histories(spark):
    rows = dense("2024-07-04", 35, value=lambda i: 0.0) + dense("2024-07-04", 35, city="up", value=lambda i: 5.0 + i % 7)
    entry = {"HW": {"model": "ExponentialSmoothing", "params": {"seasonal_periods": 7, "seasonal": "mul", "damped": True}}}
    found, errors = roster.forecast_with_errors(arrays(spark, rows), CFG, entry, "full", errors=True)
    assert {r["city"] for r in found.collect()} == {"up"}
    assert values(errors, "city", "error") == [("B1", "incomplete forecast")]


@pytest.mark.parametrize("bad", [{"alpha": 0.1}, {"trend": "x"}, {"seasonal": "x"}, {"search": "x"}])
def test_holt_winters_rejects(bad):
    with pytest.raises(ValueError):
        winters.holt_winters(F.col("y"), 1, **bad)


def test_trend_seasonal(spark):
    line = fold(spark, [3 + 2 * t for t in range(1, 7)], lambda y: closed_form.trend_seasonal(y, 2))
    assert line == pytest.approx([17.0, 19.0])
    # a constant weekly pattern over whole weeks has its own small slope; compare with numpy
    import numpy as np

    y = np.array([5.0, 1, 2, 8, 3, 0, 4] * 4 + [6.0, 1])
    t = np.arange(1, len(y) + 1)
    slope, level = np.polyfit(t, y, 1)
    residual = y - level - slope * t
    effect = np.array([residual[k::7].mean() for k in range(7)])
    effect -= effect.mean()
    expected = [level + slope * (len(y) + h) + effect[(len(y) + h - 1) % 7] for h in range(1, 10)]
    assert fold(spark, y, lambda c: closed_form.trend_seasonal(c, 9)) == pytest.approx(expected)


@pytest.mark.parametrize("label", list(roster.DEFAULT_ROSTER))
def test_horizon_dates(spark, label):
    entry = {label: roster.DEFAULT_ROSTER[label]}
    known = arrays(spark, dense("2024-07-04", 35), replace(CFG, steps=2))
    on_test = roster.forecast_series(known, replace(CFG, steps=2), entry, "test")
    ahead = roster.forecast_series(known, replace(CFG, steps=2), entry, "full")
    assert on_test.columns == ["model", "city", "product_id", "date", "sales"]
    assert values(on_test, "model", "date") == [(label, d) for d in days("2024-08-01", 7)]
    assert values(ahead, "date") == [(d,) for d in days("2024-08-08", 2)]


def test_short_series_are_left_out_model_by_model(spark):
    rows = dense("2024-07-04", 35) + dense("2024-07-26", 13, product="short") + dense(
        "2024-08-05", 3, product="new"
    )
    known = arrays(spark, rows)
    table = roster.model_eligibility(known, CFG, roster.DEFAULT_ROSTER, "test")
    eligible = {(r["product_id"], r["model"]) for r in table.filter("eligible").collect()}
    assert {m for p, m in eligible if p == "short"} == {"TrendSeasonal", "Croston", "NaiveMean"}
    assert not [m for p, m in eligible if p == "new"]
    found = roster.forecast_series(known, CFG, roster.DEFAULT_ROSTER, "test")
    assert {tuple(r) for r in found.select("product_id", "model").distinct().collect()} == eligible


def test_champions_only_gives_the_rows_of_choosing_afterwards(spark):
    rows = dense("2024-07-04", 35) + dense("2024-07-04", 35, product="q", value=lambda i: float(i % 7))
    known = arrays(spark, rows)
    champions = spark.createDataFrame(
        [("Croston", "B1", P1), ("ExponentialSmoothing", "B1", "q")], "model string, city string, product_id string"
    )
    every = roster.forecast_series(known, CFG, roster.DEFAULT_ROSTER, "full")
    chosen = every.join(champions, ["model", "city", "product_id"], "left_semi")
    direct = roster.forecast_with_errors(known, CFG, roster.DEFAULT_ROSTER, "full", champions)[0]
    assert values(direct) == values(chosen) and direct.count() == 18


def test_unknown_models_are_rejected(spark):
    with pytest.raises(ValueError, match="unknown model"):
        roster.resolve("Nothing")
    with pytest.raises(ValueError, match="no models"):
        roster.forecast_series(arrays(spark, dense("2024-07-04", 35)), CFG, {}, "full")
    with pytest.raises(ValueError, match="horizon"):
        roster.forecast_series(arrays(spark, dense("2024-07-04", 35)), CFG, roster.DEFAULT_ROSTER, "x")


def test_configured_class_names_and_parameters():
    assert roster.resolve("XGBModel") == "gbt"
    params = {"random_state": 0, "lags": 7, "n_jobs": 1, "n_estimators": 100, "max_depth": 6}
    assert roster.resolve_params("random_forest", params) == {
        "seed": 0,
        "lags": 7,
        "trees": 100,
        "depth": 6,
    }
    assert roster.resolve_params("holt_winters", {"random_state": 0, "seasonal_periods": 7}) == {"period": 7}


def test_lag_features(spark):
    df = inputs(spark, dense("2024-07-01", 9))
    rows = values(pooled.lag_features(df, CFG), "date", "sales", "lag_1", "lag_7", "weekday")
    assert rows == [(day("2024-07-08"), 8.0, 7.0, 1.0, 0), (day("2024-07-09"), 9.0, 8.0, 2.0, 1)]


def test_training_rows_are_the_lag_features_of_the_scaled_series(spark):
    known, _ = roster.history_of(arrays(spark, dense("2024-07-20", 19)), CFG, "full")
    scaled = pooled.scaled_series(known, CFG, 7)
    found = [(list(r["features"]), r["label"]) for r in pooled.training_rows(scaled, CFG, 7).collect()]
    expected = pooled.lag_features(inputs(spark, dense("2024-07-20", 19)), CFG).collect()
    mean = sum(range(1, 20)) / 19
    assert len(found) == len(expected) == 12
    for (features, label), row in zip(found, sorted(expected, key=lambda r: r["date"])):
        assert label == pytest.approx(row["sales"] / mean)
        lags = [row[f"lag_{k}"] / mean for k in range(7, 0, -1)]
        assert features == pytest.approx([*lags, float(row["weekday"])])


@pytest.mark.parametrize("model", ["random_forest", "gbt"])
def test_pooled_models(spark, model):
    rows = []
    for k in range(6):
        rows += dense("2024-07-01", 38, city=f"c{k}", value=lambda i, k=k: (k + 1) * (5.0 + i % 7))
    rows += dense("2024-08-03", 5, city="short")
    entry = {model: {"model": model, "params": {"trees": 5, "depth": 4}}}
    known = arrays(spark, rows)
    found = roster.forecast_series(known, CFG, entry, "full")
    assert found.count() == 6 * 9 and found.filter("city = 'short'").count() == 0
    assert values(found) == values(roster.forecast_series(known, CFG, entry, "full"))
    # the weekly pattern carries over, at each series' own size
    worst = found.select(
        F.max(F.abs(F.col("sales") / (F.substring("city", 2, 1).cast("int") + 1) - 8.0)).alias("w")
    ).first()["w"]
    assert worst < 4.5


def test_pooled_model_without_a_long_enough_series(spark):
    entry = {"rf": {"model": "random_forest", "params": {"trees": 2}}}
    known = arrays(spark, dense("2024-08-03", 5))
    assert roster.forecast_series(known, CFG, entry, "full").count() == 0


def test_plugin_failures_are_kept_apart(spark):
    def picky(pdf, steps, limit=10):
        if len(pdf) < limit:
            raise RuntimeError(f"only {len(pdf)} days")
        return plugin.last_value(pdf, steps)

    plugin.register_model("picky", picky)
    known = arrays(spark, dense("2024-07-04", 35) + dense("2024-08-03", 5, product="q"))
    entry = {"Picky": {"model": "picky", "params": {"limit": 6}}}
    found, errors = roster.forecast_with_errors(known, CFG, entry, "full", errors=True)
    assert values(found, "model", "product_id", "date", "sales") == [
        ("Picky", P1, d, 35.0) for d in days("2024-08-08", 9)
    ]
    assert values(errors) == [("Picky", "B1", "q", "RuntimeError: only 5 days")]
    with pytest.raises(ValueError):
        plugin.plugin_forecast(known, CFG, 1, "x", "nothing")


def test_plugin_sees_the_series_as_a_frame(spark):
    def check(pdf, steps):
        assert list(pdf.columns) == ["date", "sales", "city", "product_id"]
        ahead = [pdf["date"].iloc[-1] + timedelta(days=k) for k in range(1, steps + 1)]
        return pd.DataFrame({"date": ahead, "sales": pdf["sales"].sum()})

    plugin.register_model("check", check)
    known, steps = roster.history_of(arrays(spark, dense("2024-07-29", 10)), CFG, "test")
    found = plugin.plugin_forecast_only(known, CFG, steps, "check", "check")
    assert values(found, "date", "sales") == [(d, 6.0) for d in days("2024-08-01", 7)]


def test_partial_paths_are_errors_and_win_nothing(spark):
    def spoilt(pdf, steps):
        found = plugin.last_value(pdf, steps)
        found.loc[1:, "sales"] = float("nan")
        return found

    plugin.register_model("spoilt", spoilt)
    daily = inputs(spark, dense("2024-07-04", 35))
    models = {"Spoilt": {"model": "spoilt"}, "NaiveMean": {"model": "mean"}}
    known = series.series_arrays(series.prepare_series(daily, CFG), CFG)
    found, errors = roster.forecast_with_errors(known, CFG, models, "test", errors=True)
    assert values(found.select("model").distinct()) == [("NaiveMean",)]
    assert values(errors, "model") == [("Spoilt",)]
    assert workflow.published_demand(daily, CFG, models).count() == 3


def test_a_closed_form_path_that_is_not_finite_is_an_error(spark):
    known = arrays(spark, dense("2024-07-04", 35, value=lambda i: float("inf") if i == 3 else 1.0))
    entry = {"NaiveMean": {"model": "mean"}}
    found, errors = roster.forecast_with_errors(known, CFG, entry, "full", errors=True)
    assert found.count() == 0
    assert values(errors) == [("NaiveMean", "B1", P1, "incomplete forecast")]


def test_class_style_models(spark):
    class Twice:
        def fit(self, series):
            assert list(series.index.day)[:2] == [29, 30]
            self.last = series.iloc[-1]

        def predict(self, n):
            return [2 * self.last] * n

    class Wide(Twice):
        def predict(self, n):
            return [[1.0, 2.0]] * n

    plugin.register_class("twice", Twice)
    plugin.register_class("wide", Wide)
    known = arrays(spark, dense("2024-07-29", 10))
    entry = {"Twice": {"model": "twice"}, "Wide": {"model": "wide"}}
    found, errors = roster.forecast_with_errors(known, CFG, entry, "full", errors=True)
    assert values(found, "model", "date", "sales") == [("Twice", d, 20.0) for d in days("2024-08-08", 9)]
    assert values(errors, "model", "error") == [("Wide", "ValueError: incomplete forecast: not one value per day")]


def test_unknown_parameters_are_rejected():
    with pytest.raises(ValueError, match="windw"):
        roster.resolve_params("moving_average", {"windw": 3})
    with pytest.raises(ValueError, match="reg_lambda"):
        roster.resolve_params("random_forest", {"reg_lambda": 3})
    with pytest.warns(UserWarning, match="booster"):
        assert roster.resolve_params("gbt", {"booster": "dart", "n_jobs": 4, "n_estimators": 5}) == {"trees": 5}


def test_parameters_that_switch_nothing_on_pass_quietly(recwarn):
    given = {"booster": "gbtree", "alpha": 0, "lambda": 1, "gamma": 0, "max_delta_step": 0, "min_child_weight": 2}
    assert roster.resolve_params("gbt", given) == {"l1": 0, "l2": 1, "gamma": 0, "min_weight": 2}
    assert roster.resolve_params("changepoint_trend", {"daily_seasonality": False, "seasonality_mode": "multiplicative"}) == {
        "mode": "multiplicative"
    }
    assert not recwarn.list


def test_plugins_do_not_shuffle(spark):
    known = spark.createDataFrame([("B1", P1, day("2024-07-01"), [1.0, 2.0])], "city string, product_id string, first_day date, y array<double>")
    found = plugin.plugin_forecast_only(known, CFG, 2, "x", "last_value")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert values(found, "date", "sales") == [(day("2024-07-03"), 2.0), (day("2024-07-04"), 2.0)]


def test_a_plugin_forecasts_and_fails_in_batches(spark, monkeypatch):
    def odd(pdf, steps):
        if int(pdf["city"].iloc[0]) % 3 == 0:
            raise RuntimeError("no")
        return plugin.last_value(pdf, steps)

    monkeypatch.setattr(plugin, "TOGETHER", 4)
    plugin.register_model("odd", odd)
    known = spark.createDataFrame(
        [(str(k), P1, day("2024-07-01"), [float(k)]) for k in range(30)], "city string, product_id string, first_day date, y array<double>"
    )
    found, errors = plugin.plugin_forecast(known, CFG, 2, "x", "odd")
    assert found.count() == 40 and errors.count() == 10


def test_scores_and_champions_of_all_models_by_sql_over_the_stored_forecasts(spark, tmp_path):
    import duckdb

    rows = []
    for k in range(4):
        rows += dense("2024-07-01", 38, city=f"c{k}", value=lambda i, k=k: (k + 1) * (5.0 + i % 7) + (i * 31 * (k + 1)) % 9)
    models = {
        label: {"model": e["model"], "params": e["params"] | ({"trees": 3, "depth": 3} if e["model"] in roster.POOLED else {})}
        for label, e in roster.FULL_ROSTER.items()
    }
    known = arrays(spark, rows)
    on_test = roster.forecast_series(known, CFG, models, "test")
    actual = workflow.test_rows(known, CFG)
    on_test.write.parquet(str(tmp_path / "f"))
    actual.write.parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    metrics = evaluate.forecast_metrics(actual, stored, CFG, ["mae", "rmse"])
    champions = evaluate.best_models(metrics, CFG)
    con = duckdb.connect()
    scored = f"""select f.model, f.city, f.product_id, avg(abs(f.sales - a.sales)) as mae, sqrt(avg(power(f.sales - a.sales, 2))) as rmse
from '{tmp_path}/f/*.parquet' f join '{tmp_path}/a/*.parquet' a using (city, product_id, date) group by 1, 2, 3"""
    expected = con.execute(f"select model, city, mae, rmse from ({scored}) order by 1, 2").fetchall()
    assert len(expected) == 7 * 4
    found = metrics.groupBy("model", "city").pivot("metric", ["mae", "rmse"]).agg(F.first("value"))
    for f, e in zip(values(found), expected):
        assert f[:2] == e[:2] and f[2:] == pytest.approx(e[2:])
    best = con.execute(f"select model, city from ({scored}) qualify row_number() over (partition by city order by mae, model) = 1 order by 1, 2")
    assert values(champions, "model", "city") == best.fetchall()
