"""Demand forecasting and data-quality analytics as Spark DataFrame operators."""

from demandloom.config import Settings, load_settings

__all__ = ["Settings", "load_settings"]
