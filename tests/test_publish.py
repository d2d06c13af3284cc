from dataclasses import replace

from helpers import CFG, P1, P2, day, days, inputs, values

from demandloom import schemas
from demandloom.operators import publish, reports


def forecast_of(spark, rows):
    return spark.createDataFrame(rows, schemas.FORECAST)


def nine_days(spark, start=1.0):
    rows = [("M", "B1", P1, d, start + i) for i, d in enumerate(days("2024-08-08", 9))]
    return forecast_of(spark, rows)


def demand_rows(spark):
    return inputs(spark, [("B1", P1, day("2024-07-09"), 5.0), ("B3", P2, day("2024-08-06"), 1.0)])


def test_published_demand(spark):
    out = publish.publish_demand(demand_rows(spark), nine_days(spark), CFG)
    assert values(out, "city", "date", "sales") == [
        ("B1", day("2024-08-08"), 28.0),
        ("B1", day("2024-08-09"), 35.0),
        ("B1", day("2024-08-10"), 42.0),
        ("B3", day("2024-08-08"), 1.0),
        ("B3", day("2024-08-09"), 1.0),
        ("B3", day("2024-08-10"), 1.0),
    ]


def test_no_forecast_no_output(spark):
    assert publish.publish_demand(demand_rows(spark), forecast_of(spark, []), CFG).count() == 0


def test_short_forecast_has_no_whole_window(spark):
    short = nine_days(spark).filter("date < '2024-08-14'")
    assert publish.weekly_forecast(short, CFG).count() == 0


def test_fallback_is_the_mean_of_observed_days(spark):
    demand = inputs(
        spark,
        [("B3", P2, day("2024-01-01"), 2.0), ("B3", P2, day("2024-08-06"), 5.0), ("B1", P1, day("2024-08-06"), 9.0)],
    )
    weekly = publish.weekly_forecast(nine_days(spark), CFG)
    assert values(publish.fallback_forecast(demand, weekly, CFG), "sales") == [(3.5,)] * 3
    scaled = publish.fallback_forecast(demand, weekly, replace(CFG, scale_fallback=True))
    assert values(scaled, "sales") == [(24.5,)] * 3
    assert values(publish.unforecast_series(demand, weekly, CFG)) == [("B3", P2)]
    assert publish.output_periods(weekly, CFG).count() == 3


def test_output_is_never_negative(spark):
    out = publish.publish_demand(
        inputs(spark, [("B3", P2, day("2024-08-06"), -1.0)]), nine_days(spark, start=-20.0), CFG
    )
    assert values(out, "sales") == [(0.0,)] * 6


def test_other_column_names(spark):
    cfg = replace(CFG, group_columns=("store",), time_column="day", target_column="units")
    forecast = nine_days(spark).selectExpr("model", "city store", "date day", "sales units")
    demand = demand_rows(spark).selectExpr("city store", "date day", "sales units")
    out = publish.publish_demand(demand, forecast, cfg)
    assert out.columns == ["store", "day", "units"] and out.count() == 6


def test_one_sort_and_no_cross_join(spark):
    weekly = publish.weekly_forecast(nine_days(spark), CFG)
    plan = weekly._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Window [") == 1
    out = publish.publish_demand(demand_rows(spark), nine_days(spark), CFG)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_reports(spark):
    forecasts = forecast_of(
        spark, [(m, "c", P1, day("2024-08-01"), v) for m, v in (("A", 1.0), ("B", 2.0))] * 2
    )
    metric_rows = [("A", "c", P1, "mae", 1.0), ("B", "c", P1, "mae", 2.0), ("B", "c", P1, "rmse", 3.0)]
    metrics = spark.createDataFrame(metric_rows, schemas.METRICS)
    best = metrics.filter("model = 'A'")
    assert values(reports.metrics_with_champion(metrics, best), "model", "value") == [
        ("A", 1.0),
        ("B", 2.0),
        ("Champion", 1.0),
    ]
    # champions keep the metric they were chosen by
    by_rmse = metrics.filter("metric = 'rmse'")
    assert ("Champion", "rmse") in values(reports.metrics_with_champion(metrics, by_rmse), "model", "metric")

    split = spark.createDataFrame(
        [("c", P1, day("2024-08-01"), 4.0, "test"), ("c", P1, day("2024-07-01"), 9.0, "train")], schemas.SPLIT
    )
    report = reports.champion_vs_actual(forecasts, best, split, CFG)
    assert values(report, "model", "sales") == [("A", 1.0), ("B", 2.0), ("Champion", 1.0), ("Sales", 4.0)]
    assert values(reports.volume_by(forecasts, ["model"], CFG)) == [("A", 2.0), ("B", 4.0)]


def test_table_diff_is_a_multiset_difference(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    right = spark.createDataFrame([(1,), (3,)], "x int")
    assert values(reports.table_diff(left, right)) == [("left", 1), ("left", 2), ("right", 3)]
    assert reports.table_diff(left, left).count() == 0
