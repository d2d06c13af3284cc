from datetime import date, datetime
from zoneinfo import ZoneInfo

import pytest

from demandloom import Settings, load_settings
from demandloom.config import days_of

CONFIG = """
common: &common
  env: test
  tz: America/Santiago
  execution_date: 2024-08-08
  database: shop
series: &series
  group_columns: [city, product_id]
  time_column: date
  target_column: sales
ingestion: {<<: *common, dir: data, sep: ";", cities: [A, B]}
split: {<<: [*common, *series], time_delta: 68, test_size: 7, freq: 1D}
models:
  NaiveMean: {<<: [*common, *series], model_cls: NaiveMean, test_size: 7, steps: 9}
  Short:
    <<: [*common, *series]
    model_cls: NaiveMovingAverage
    model_params: {input_chunk_length: 3}
    test_size: 7
    steps: 9
evaluation: {<<: [*common, *series], metrics: [rmse, mae], model_selection_metric: mae}
output: {<<: [*common, *series], window_size: 7}
"""


def write(tmp_path, text):
    path = tmp_path / "conf.yml"
    path.write_text(text)
    return str(path)


def test_settings_from_yaml(tmp_path):
    cfg = load_settings(write(tmp_path, CONFIG))
    assert cfg.database == "shop" and cfg.sep == ";" and cfg.cities == ("A", "B")
    assert cfg.execution_date == date(2024, 8, 8)
    assert (cfg.time_delta, cfg.test_size, cfg.steps, cfg.window_size) == (68, 7, 9, 7)
    assert cfg.metrics == ("rmse", "mae") and cfg.selection_metric == "mae"
    assert cfg.models["Short"] == {
        "model": "NaiveMovingAverage",
        "params": {"input_chunk_length": 3},
    }


@pytest.mark.parametrize(
    "old, new, message",
    [
        ("model_cls: NaiveMean", "model_cls: Nothing", "unknown model"),
        ("metrics: [rmse, mae]", "metrics: [rmse, nothing]", "unknown metric"),
        ("model_selection_metric: mae", "model_selection_metric: nothing", "unknown metric"),
        ("time_delta: 68", "time_delta: 0", "time_delta"),
        ("freq: 1D", "freq: 12h", "whole number of days"),
    ],
)
def test_bad_settings_are_rejected(tmp_path, old, new, message):
    with pytest.raises(ValueError, match=message):
        load_settings(write(tmp_path, CONFIG.replace(old, new)))


def test_execution_date_defaults_to_today_in_the_time_zone():
    cfg = Settings(tz="Pacific/Kiritimati")
    assert cfg.execution_date == datetime.now(tz=ZoneInfo("Pacific/Kiritimati")).date()


def test_frequencies_are_whole_days():
    assert [days_of(f) for f in ("D", "1D", "7d", " 2D ")] == [1, 1, 7, 2]
    for freq in ("1h", "0D", "W", ""):
        with pytest.raises(ValueError):
            days_of(freq)


def test_offsets_scale_with_the_frequency_but_the_end_does_not():
    cfg = Settings(execution_date=date(2024, 8, 8), time_delta=4, test_size=2, freq="7D")
    assert cfg.start_date == date(2024, 7, 11)
    assert cfg.end_date == date(2024, 8, 7)
    assert cfg.train_end == date(2024, 7, 24)


# The model section of a configuration in use.
MODELS = """
common:
  execution_date: 2024-08-08
models:
  ExponentialSmoothing:
    model_cls: ExponentialSmoothing
    model_params: {random_state: 0, seasonal_periods: 7}
  Prophet:
    model_cls: Prophet
  XGBModel:
    model_cls: XGBModel
    model_params:
      random_state: 0
      objective: reg:squarederror
      lags: 7
      nthread: 1
      max_depth: 6
      learning_rate: 0.3
      gamma: 0
      lambda: 1
      alpha: 0
  RandomForest:
    model_cls: RandomForest
    model_params: {random_state: 0, lags: 7, n_jobs: 1, n_estimators: 100, max_depth: 6}
  Croston:
    model_cls: Croston
    model_params: {version: sba}
  NaiveMean:
    model_cls: NaiveMean
  NaiveMovingAverage:
    model_cls: NaiveMovingAverage
    model_params: {input_chunk_length: 7}
"""


def test_a_whole_model_section_loads_without_warnings(tmp_path, recwarn):
    path = tmp_path / "conf.yml"
    path.write_text(MODELS)
    assert len(load_settings(str(path)).models) == 7
    assert not [w for w in recwarn.list if w.category is UserWarning]


def test_unknown_parameters_fail_when_settings_are_loaded(tmp_path):
    path = tmp_path / "conf.yml"
    path.write_text(MODELS.replace("max_depth: 6}", "max_dept: 6}"))
    with pytest.raises(ValueError, match="max_dept"):
        load_settings(str(path))
