"""Run settings: one frozen dataclass, optionally read from a YAML file."""

from __future__ import annotations

import pathlib
import re
from dataclasses import dataclass, field, fields
from datetime import date, datetime, timedelta
from typing import Any
from zoneinfo import ZoneInfo

import yaml

_WHOLE_DAYS = re.compile(r"^\s*(\d*)\s*D\s*$", re.IGNORECASE)


def days_of(freq: str) -> int:
    """Days in a frequency such as ``1D``; only whole-day multiples are supported."""
    match = _WHOLE_DAYS.match(freq)
    days = int(match.group(1) or 1) if match else 0
    if days < 1:
        raise ValueError(f"frequency {freq!r} is not a whole number of days, e.g. '1D'")
    return days


@dataclass(frozen=True)
class Settings:
    env: str = "dev"
    database: str = "dev"
    tz: str = "America/Santiago"
    execution_date: date | None = None
    group_columns: tuple[str, ...] = ("city", "product_id")
    time_column: str = "date"
    target_column: str = "sales"
    freq: str = "1D"
    # ingestion
    dir: str = "data"
    sep: str = ","
    cities: tuple[str, ...] | None = None
    # split, models
    time_delta: int = 2 * 52 * 7
    test_size: int = 21
    steps: int = 21
    models: dict[str, dict[str, Any]] = field(default_factory=dict)
    # evaluation
    metrics: tuple[str, ...] = ("rmse", "mae", "mape")
    selection_metric: str = "mape"
    # output
    window_size: int = 7
    scale_fallback: bool = False

    def __post_init__(self):
        # today in the run's own time zone, never the cluster's
        if self.execution_date is None:
            today = datetime.now(tz=ZoneInfo(self.tz)).date()
            object.__setattr__(self, "execution_date", today)
        for name in ("time_delta", "test_size", "steps", "window_size"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be greater than 0")
        for name in ("group_columns", "metrics", "cities"):
            value = getattr(self, name)
            if isinstance(value, list):
                object.__setattr__(self, name, tuple(value))
        days_of(self.freq)

    @property
    def groups(self) -> list[str]:
        return list(self.group_columns)

    @property
    def freq_days(self) -> int:
        return days_of(self.freq)

    @property
    def start_date(self) -> date:
        return self.execution_date - timedelta(days=self.time_delta * self.freq_days)

    @property
    def end_date(self) -> date:
        """Always one calendar day before execution, whatever the frequency."""
        return self.execution_date - timedelta(days=1)

    @property
    def train_end(self) -> date:
        return self.end_date - timedelta(days=self.test_size * self.freq_days)


def load_settings(path: str) -> Settings:
    """Settings from a YAML file with sections common, ingestion, split, models,
    evaluation and output.

    Every model shares one horizon, so ``steps`` comes from the models' section and
    models that disagree on it are rejected.
    """
    from demandloom.functions.metrics import check_metrics
    from demandloom.models.roster import check_models

    config = yaml.safe_load(pathlib.Path(path).read_text())
    known = {f.name for f in fields(Settings)} - {"models"}
    merged: dict[str, Any] = {}
    for section in ("common", "ingestion", "split", "evaluation", "output"):
        values = dict(config.get(section) or {})
        if "model_selection_metric" in values:
            values["selection_metric"] = values.pop("model_selection_metric")
        merged.update({k: v for k, v in values.items() if k in known})

    models: dict[str, dict[str, Any]] = {}
    for label, entry in (config.get("models") or {}).items():
        for name in ("steps", "test_size"):
            if name in entry and merged.setdefault(name, entry[name]) != entry[name]:
                raise ValueError(f"models disagree on {name}")
        models[label] = {
            "model": entry.get("model_cls", label),
            "params": dict(entry.get("model_params") or {}),
        }
    settings = Settings(models=models, **merged)
    check_metrics([*settings.metrics, settings.selection_metric])
    check_models(models)
    return settings
