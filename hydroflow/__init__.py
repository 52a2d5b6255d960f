"""Hydropower time-series analytics on Spark DataFrames."""

from hydroflow.config import ForecastConfig

__all__ = ["ForecastConfig"]
