"""Forecasting and battery-degradation analytics as Spark jobs."""

from fadecast.spec import SeriesSpec

__all__ = ["SeriesSpec"]
