import numpy as np
import pytest
from helpers import values
from pyspark.sql import functions as F

from demandloom.models import changepoints
from demandloom.models.changepoints import changepoint_trend


def paths(spark, histories, steps=9, **params):
    df = spark.createDataFrame([(i, None if y is None else [float(v) for v in y]) for i, y in enumerate(histories)], "i int, y array<double>")
    return [p for _, p in values(df.select("i", changepoint_trend(F.col("y"), steps, **params).alias("p")))]


def brute(y, steps, places, weekly, prior, noise, season_prior=10.0, growth="linear"):
    """Least squares with one more row per coefficient that pulls it to 0."""
    y, n = np.array(y, float), len(y)
    size = np.abs(y).max() or 1.0

    def basis(i):
        t = i / (n - 1)
        columns = [1.0] if growth == "flat" else [1.0, t, *(max(0.0, t - s / (n - 1)) for s in places)]
        for k in range(1, weekly + 1):
            columns += [np.sin(2 * np.pi * k * i / 7), np.cos(2 * np.pi * k * i / 7)]
        return columns

    rows = np.array([basis(i) for i in range(n)])
    line = 1 if growth == "flat" else 2
    widths = [5.0] * line + [prior] * (rows.shape[1] - line - 2 * weekly) + [season_prior] * (2 * weekly)
    pull = np.diag([noise / w for w in widths])
    found = np.linalg.lstsq(np.vstack([rows, pull]), np.concatenate([y / size, np.zeros(len(widths))]), rcond=None)[0]
    return size * np.array([basis(i) for i in range(n, n + steps)]) @ found


@pytest.mark.parametrize("growth", ["linear", "flat"])
@pytest.mark.parametrize("weekly", [0, 3])
def test_equals_penalised_least_squares(spark, growth, weekly):
    rng = np.random.default_rng(3)
    histories = [rng.integers(0, 30, n) for n in (30, 30, 68, 15, 100)]
    found = paths(spark, histories, growth=growth, changepoints=4, changepoint_prior=0.3, weekly=weekly, yearly=False, noise=0.1)
    for y, path in zip(histories, found):
        last = int(len(y) * 0.8) - 1
        places = [round(last * k / 4) for k in range(1, 5)]
        assert changepoints.changepoint_places(len(y), 4, 0.8).tolist() == places
        assert path == pytest.approx(brute(y, 9, places, weekly, 0.3, 0.1, growth=growth), rel=1e-6, abs=1e-6)


def test_planted_break_and_week_are_recovered(spark):
    days = np.arange(120)
    week = np.array([0, 5, 9, 3, -4, -8, -5])[days % 7]
    y = np.where(days < 60, 100 + days, 160 + 3 * (days - 60)) + week + np.random.default_rng(0).normal(0, 0.5, 120)
    ahead = np.arange(120, 134)
    truth = 160 + 3 * (ahead - 60) + np.array([0, 5, 9, 3, -4, -8, -5])[ahead % 7]
    (found,) = paths(spark, [y], 14, yearly=False)
    assert np.abs(np.array(found) - truth).max() < 6
    # without room to bend, the line misses the new slope
    (stiff,) = paths(spark, [y], 14, yearly=False, changepoint_prior=1e-5)
    assert np.abs(np.array(stiff) - truth).max() > 20
    (level,) = paths(spark, [y], 14, yearly=False, growth="flat")
    assert np.mean(level) == pytest.approx(y.mean(), rel=0.05)


def test_season_as_a_factor(spark):
    days = np.arange(140)
    factor = np.array([1.0, 1.3, 1.6, 1.2, 0.7, 0.5, 0.7])
    y = (20 + 2.0 * days) * factor[days % 7]
    ahead = np.arange(140, 154)
    truth = (20 + 2.0 * ahead) * factor[ahead % 7]
    error = {
        mode: np.abs(np.array(paths(spark, [y], 14, mode=mode, yearly=False)[0]) - truth).mean()
        for mode in ("additive", "multiplicative")
    }
    assert error["multiplicative"] < 0.2 * error["additive"] and error["multiplicative"] < 10


def test_odd_histories(spark):
    found = paths(spark, [None, [], [1.0, float("nan")], [4.0, 4.0], [0.0] * 20, [1.0, None, 2.0] if False else [7.0]])
    assert found[0] is None and found[1] is None and found[2] is None
    assert found[3] == pytest.approx([4.0] * 9, rel=1e-2)
    assert found[4] == pytest.approx([0.0] * 9, abs=1e-9)
    assert found[5] == pytest.approx([7.0] * 9, rel=1e-2)


def test_a_year_has_a_season_with_two_years_of_history(spark):
    days = np.arange(900)
    y = 50 + 20 * np.sin(2 * np.pi * days / 365.25)
    truth = 50 + 20 * np.sin(2 * np.pi * np.arange(900, 960) / 365.25)
    (found,) = paths(spark, [y], 60)
    assert np.abs(np.array(found) - truth).max() < 3


@pytest.mark.parametrize("bad", [{"growth": "logistic"}, {"mode": "other"}, {"changepoint_prior": 0}, {"changepoint_range": 0}])
def test_rejected(bad):
    with pytest.raises(ValueError):
        changepoint_trend(F.lit(None), 1, **bad)
