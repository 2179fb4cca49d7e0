"""Hourly sensor data on a spatial grid, as PySpark jobs."""

__version__ = "0.1.0"
