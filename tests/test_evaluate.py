import random
import statistics

import pytest
from helpers import CFG, P1, day, inputs, values
from pyspark.sql import functions as F

from demandloom import schemas
from demandloom.functions.metrics import PandasMetric, check_metrics, mape
from demandloom.functions.selection import exact_median
from demandloom.operators import evaluate

ACTUAL = [("B1", P1, day("2024-08-06"), 9.0), ("B1", P1, day("2024-08-07"), 10.0)]
PREDICTED = [
    ("A", "B1", P1, day("2024-08-06"), 7.3),
    ("A", "B1", P1, day("2024-08-07"), 11.8),
    ("B", "B1", P1, day("2024-08-06"), 8.5),
    ("B", "B1", P1, day("2024-08-07"), 10.7),
    ("B", "B1", P1, day("2024-08-08"), 99.0),
]


def scored(spark, metrics, actual=ACTUAL, predicted=PREDICTED, train=None):
    df = evaluate.forecast_metrics(
        inputs(spark, actual), spark.createDataFrame(predicted, schemas.FORECAST), CFG, metrics, train
    )
    assert df.columns == schemas.METRICS.fieldNames()
    return {(r["model"], r["metric"]): r["value"] for r in df.collect()}


def one(spark, metric, actual, predicted):
    rows = [("c", "p", day(f"2024-08-0{i + 1}"), float(v)) for i, v in enumerate(actual)]
    made = [("M", "c", "p", day(f"2024-08-0{i + 1}"), float(v)) for i, v in enumerate(predicted)]
    return next(iter(scored(spark, [metric], rows, made).values()))


def test_metrics(spark):
    found = scored(spark, ["rmse", "mae", "mape"])
    expected = {
        ("A", "rmse"): 1.750714,
        ("A", "mae"): 1.75,
        ("A", "mape"): 0.184444,
        ("B", "rmse"): 0.608276,
        ("B", "mae"): 0.6,
        ("B", "mape"): 0.062778,
    }
    assert found == pytest.approx(expected, abs=1e-6)


def test_mape_with_zero_actuals(spark):
    assert one(spark, "mape", [0, 2], [0, 1]) == 0.5
    assert one(spark, "mape", [0, 2], [1, 1]) == float("inf")
    assert one(spark, "mape", [0, 0], [0, 0]) is None
    assert one(spark, mape(epsilon=1.0), [0, 1], [1, 1]) == 0.5


def test_further_metrics(spark):
    y, p = [1.0, 2.0, 4.0], [2.0, 2.0, 2.0]
    assert one(spark, "mse", y, p) == pytest.approx(5 / 3)
    assert one(spark, "wmape", y, p) == pytest.approx(300 / 7)
    assert one(spark, "smape", y, p) == pytest.approx(200 * (1 / 3 + 2 / 6) / 3)
    assert one(spark, "bias", y, p) == pytest.approx(-1 / 3)
    assert one(spark, "r2", y, p) == pytest.approx(1 - 5 / (14 / 3))
    assert one(spark, "mape_pct", y, p) == pytest.approx(100 * 1.5 / 3)
    assert one(spark, "rmsle", [0, 3], [0, -2]) is None


def test_mase_uses_the_training_days(spark):
    train = inputs(spark, [("B1", P1, day(f"2024-07-0{i}"), v) for i, v in ((1, 1.0), (2, 3.0), (3, 2.0))])
    assert scored(spark, ["mase"], train=train)[("A", "mase")] == pytest.approx(1.75 / 1.5)
    with pytest.raises(ValueError, match="training"):
        scored(spark, ["mase"])


def test_user_metrics(spark):
    def worst(y, p):
        return F.max(F.abs(y - p))

    def spread(y, p):
        return (y - p).max() - (y - p).min()

    found = scored(spark, ["mae", worst, PandasMetric(spread)])
    assert found[("A", "worst")] == pytest.approx(1.8)
    assert found[("A", "spread")] == pytest.approx(3.5)
    with pytest.raises(ValueError):
        check_metrics(["nothing"])
    with pytest.raises(ValueError):
        check_metrics([3])


def test_scoring_moves_the_forecasts_once(spark):
    forecasts = spark.createDataFrame(PREDICTED, schemas.FORECAST)
    metrics = evaluate.forecast_metrics(inputs(spark, ACTUAL), forecasts, CFG)
    plan = evaluate.best_models(metrics, CFG)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Python" not in plan


def metrics_of(spark, rows):
    return spark.createDataFrame(rows, schemas.METRICS.simpleString())


def test_champion(spark):
    metrics = metrics_of(
        spark,
        [
            ("A", "B1", P1, "mae", 1.75),
            ("B", "B1", P1, "mae", 0.6),
            ("A", "B1", P1, "rmse", 0.1),
            ("Z", "tie", P1, "mae", 1.0),
            ("C", "tie", P1, "mae", 1.0),
            ("A", "bad", P1, "mae", None),
            ("B", "bad", P1, "mae", float("nan")),
            ("C", "bad", P1, "mae", 5.0),
            ("A", "none", P1, "mae", None),
        ],
    )
    best = evaluate.best_models(metrics, CFG)
    assert best.columns == schemas.METRICS.fieldNames()
    assert values(best, "city", "model", "metric", "value") == [
        ("B1", "B", "mae", 0.6),
        ("bad", "C", "mae", 5.0),
        ("tie", "C", "mae", 1.0),
    ]
    assert evaluate.champion_mean_metric(best).first()["value"] == pytest.approx(2.2)
    ahead = spark.createDataFrame(
        [(m, "B1", P1, day("2024-08-08"), v) for m, v in (("A", 7.0), ("B", 8.5))], schemas.FORECAST
    )
    assert values(evaluate.champion_forecast(ahead, best, CFG), "model", "sales") == [("B", 8.5)]


@pytest.mark.parametrize("seed", range(3))
def test_exact_median(spark, seed):
    rng = random.Random(seed)
    groups = {
        "tail": [rng.paretovariate(0.4) for _ in range(501)],
        "peak": [1.0 + rng.random() * 1e-9 for _ in range(400)],
        "zeros": [0.0] * 300 + [rng.random() for _ in range(200)],
        "signed": [rng.gauss(0, 1e3) for _ in range(200)],
        "even": [1.0, 2.0],
        "split": [-5.0, 1e9],
        "infinite": [1.0, float("inf"), float("inf")],
        "one": [4.5],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("one", None), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "model string, value double").repartition(3)
    found = {r["model"]: r for r in exact_median(df, ["model"], "value").collect()}
    assert set(found) == set(groups)
    for name, vs in groups.items():
        assert found[name]["median"] == statistics.median(vs)
        assert found[name]["count"] == len(vs)
        assert found[name]["mean"] == pytest.approx(sum(vs) / len(vs))
    summary = evaluate.metric_summary(df.selectExpr("model", "value"))
    assert summary.columns == ["model", "median", "mean", "count"]
