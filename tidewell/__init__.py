"""tidewell: a Spark-native engine for revenue-style time series."""

from __future__ import annotations

from importlib import import_module
from typing import Any

_HOME = {
    "AllocationConfig": "operators.allocation", "DailyAllocator": "operators.allocation", "build_daily_totals": "operators.series", "daily_to_monthly": "operators.series",
    "daily_to_weekly": "operators.series", "FeaturePipeline": "operators.features", "Validator": "operators.quality", "TimeSeriesForecaster": "plans.forecaster",
    "available_models": "plans.models", "register_model": "plans.models", "ConfigManager": "config",
}
__all__ = sorted(_HOME)


def __getattr__(name: str) -> Any:
    """The main classes and functions, imported when they are asked for: workers import the package for a part of it."""
    if name in _HOME:
        return getattr(import_module(f"tidewell.{_HOME[name]}"), name)
    raise AttributeError(name)
