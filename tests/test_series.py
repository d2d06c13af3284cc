import random
from dataclasses import replace

import pandas as pd
import pytest
from helpers import CFG, P1, day, days, dense, inputs, values

from demandloom.operators import classify, series


def test_gap_fill_and_split(spark):
    df = inputs(spark, [("B1", P1, day("2024-07-25"), 1.0), ("B1", P1, day("2024-08-06"), 7.0)])
    expected = [1.0] + [0.0] * 11 + [7.0, 0.0]
    found = values(series.prepare_series(df, CFG), "date", "sales", "split")
    assert found == [
        (d, v, "train" if i < 7 else "test")
        for i, (d, v) in enumerate(zip(days("2024-07-25", 14), expected))
    ]


def test_dense_series_is_unchanged(spark):
    df = inputs(spark, dense("2024-07-09", 30))
    split = series.prepare_series(df, replace(CFG, time_delta=727, test_size=5))
    assert values(split.drop("split")) == values(df)
    assert split.filter("split = 'test'").count() == 5


def test_window_is_inclusive_and_fill_starts_inside_it(spark):
    cfg = replace(CFG, time_delta=10)
    df = inputs(
        spark,
        [("c", P1, day(d), 1.0) for d in ("2024-07-28", "2024-07-29", "2024-08-07", "2024-08-08")],
    )
    assert values(series.history_window(df, cfg), "date") == [(day("2024-07-29"),), (day("2024-08-07"),)]
    assert series.prepare_series(df, cfg).count() == 10


def test_fill_of_nulls_and_of_a_single_row(spark):
    df = spark.createDataFrame(
        [("c", P1, day("2024-08-05"), None), ("c", "q", day("2024-08-07"), 2.0)],
        "city string, product_id string, date date, sales double",
    )
    assert values(series.gap_fill(df, CFG), "product_id", "date", "sales") == [
        (P1, day("2024-08-05"), 0.0),
        (P1, day("2024-08-06"), 0.0),
        (P1, day("2024-08-07"), 0.0),
        ("q", day("2024-08-07"), 2.0),
    ]


def test_gap_fill_to_the_last_day_of_all_series(spark):
    df = inputs(spark, [("c", P1, day("2024-08-01"), 1.0), ("c", "q", day("2024-08-03"), 2.0)])
    assert values(series.gap_fill_global(df, CFG), "product_id", "date", "sales") == [
        (P1, day("2024-08-01"), 1.0),
        (P1, day("2024-08-02"), 0.0),
        (P1, day("2024-08-03"), 0.0),
        ("q", day("2024-08-03"), 2.0),
    ]


def test_gap_fill_against_pandas(spark):
    rng = random.Random(3)
    rows = [
        (f"c{k}", P1, d, float(rng.randint(1, 9)))
        for k in range(20)
        for d in sorted(rng.sample(days("2024-06-10", 59), rng.randint(1, 30)))
    ]
    expected = []
    for city, part in pd.DataFrame(rows, columns=["c", "p", "d", "s"]).groupby("c"):
        grid = pd.date_range(part.d.min(), "2024-08-07")
        filled = part.set_index(pd.to_datetime(part.d)).s.reindex(grid).fillna(0.0)
        expected += [(city, d.date(), v) for d, v in filled.items()]
    found = series.gap_fill(inputs(spark, rows), CFG)
    assert values(found, "city", "date", "sales") == sorted(expected, key=lambda r: tuple(map(str, r)))


def test_weekly_frequency(spark):
    cfg = replace(CFG, freq="7D", time_delta=8, test_size=2)
    df = inputs(spark, [("c", P1, day("2024-07-03"), 1.0), ("c", P1, day("2024-07-24"), 4.0)])
    assert values(series.prepare_series(df, cfg), "date", "sales", "split") == [
        (day("2024-07-03"), 1.0, "train"),
        (day("2024-07-10"), 0.0, "train"),
        (day("2024-07-17"), 0.0, "train"),
        (day("2024-07-24"), 4.0, "train"),
        (day("2024-07-31"), 0.0, "test"),
        (day("2024-08-07"), 0.0, "test"),
    ]


def test_series_arrays_and_count(spark):
    rows = dense("2024-07-29", 10) + dense("2024-08-03", 5, product="q")
    split = series.prepare_series(inputs(spark, rows), CFG)
    found = {r["product_id"]: r for r in series.series_arrays(split.orderBy("sales"), CFG).collect()}
    assert found[P1]["y"] == [float(i + 1) for i in range(10)]
    assert (found[P1]["first_day"], found[P1]["n_train"]) == (day("2024-07-29"), 3)
    assert found["q"]["n_train"] == 0
    assert series.series_count(split, CFG).first()["series"] == 2


def test_arrays_reuse_the_shuffle_of_the_gap_fill(spark):
    split = series.prepare_series(inputs(spark, dense("2024-07-29", 10)), CFG)
    plan = series.series_arrays(split, CFG)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


CLASS_CASES = {
    "smooth": [5.0, 6.0, 5.0, 6.0, 5.0, 6.0, 5.0, 6.0],
    "intermittent": [5.0, 0.0, 5.0, 0.0, 5.0, 0.0, 5.0, 5.0],
    "erratic": [1.0, 50.0, 1.0, 1.0, 1.0, 60.0, 1.0, 1.0],
    "lumpy": [1.0, 0.0, 90.0, 0.0, 1.0, 0.0, 1.0, 0.0],
    "no_demand": [0.0] * 8,
}


def classified(spark):
    rows = []
    for name, ys in CLASS_CASES.items():
        for k in range(3):
            rows += [(f"{name}{k}", P1, d, y) for d, y in zip(days("2024-07-31", 8), ys)]
    rows.append(("short", P1, day("2024-08-07"), 1.0))
    filled = inputs(spark, rows)
    return filled, classify.demand_classes(filled, CFG)


def test_demand_classes(spark):
    _, classes = classified(spark)
    for row in classes.filter("city != 'short'").collect():
        ys = [y for y in CLASS_CASES[row["class"]] if y > 0]
        assert row["city"].startswith(row["class"])
        if ys:
            mean = sum(ys) / len(ys)
            variance = sum((y - mean) ** 2 for y in ys) / len(ys)
            assert row["adi"] == pytest.approx(8 / len(ys))
            assert row["cv2"] == pytest.approx(variance / mean**2)
        else:
            assert row["adi"] is None


def test_thresholds_are_strict(spark):
    df = inputs(spark, [("c", P1, d, y) for d, y in zip(days("2024-08-01", 4), [1.0, 1.0, 1.0, 0.0])])
    assert classify.demand_classes(df, CFG, adi_threshold=4 / 3).first()["class"] == "smooth"
    assert classify.demand_classes(df, CFG, adi_threshold=1.3).first()["class"] == "intermittent"


def test_class_distribution_and_samples(spark):
    filled, classes = classified(spark)
    found = {r["class"]: (r["series"], r["pct"]) for r in classify.class_distribution(classes).collect()}
    assert found["smooth"] == (4, 25.0) and found["lumpy"] == (3, 18.75)
    sample = classify.class_samples(filled, classes, CFG, per_class=2)
    assert sample.count() == 5 * 2 * 8
    assert {c for (c,) in values(sample.select("city").distinct())} == {
        f"{name}{k}" for name in CLASS_CASES for k in (0, 1)
    }
    every = classify.class_samples(filled, classes, CFG, per_class=None, only="smooth")
    assert every.count() == 3 * 8


def test_class_samples_are_limited_before_the_shuffle(spark):
    filled, classes = classified(spark)
    plan = classify.class_samples(filled, classes, CFG)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
