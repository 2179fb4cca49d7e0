"""Calibration of predictions against a reference map of daily volumes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgrid.functions.expressions import scaling_factor
from sensorgrid.session import small_side

HOURS_PER_DAY = 24


def predicted_daily_volume(predictions: DataFrame, value: str = "value") -> DataFrame:
    """Mean hourly prediction per cell, as vehicles per day."""
    return predictions.groupBy("x", "y").agg(
        (F.avg(value) * HOURS_PER_DAY).alias("kfz_per_24h_pred")
    )


def calibration_factors(
    volume: DataFrame, predictions: DataFrame, value: str = "value", volume_col: str = "kfz_per_24h"
) -> DataFrame:
    """One factor per cell that has both a reference volume and predictions."""
    both = volume.select("x", "y", F.col(volume_col).alias("kfz_per_24h")).join(
        predicted_daily_volume(predictions, value), ["x", "y"]
    )
    return both.select(
        "x",
        "y",
        "kfz_per_24h",
        "kfz_per_24h_pred",
        scaling_factor("kfz_per_24h", "kfz_per_24h_pred").alias("scaling"),
    )


def apply_factors(
    predictions: DataFrame,
    factors: DataFrame,
    value: str = "value",
    out: str = "pred",
    how: str = "inner",
    divisor: float = 1.0,
) -> DataFrame:
    """Prediction times factor. ``divisor=2`` gives one direction of a two-way count."""
    scaled: Column = F.col(value) * F.col("scaling")
    if divisor != 1.0:
        scaled = scaled / divisor
    joined = predictions.join(small_side(factors.select("x", "y", "scaling")), ["x", "y"], how)
    return joined.withColumn(out, scaled)


def scaled_union(
    vintages: Sequence[tuple[DataFrame, DataFrame]], value: str = "value"
) -> DataFrame:
    """Several runs of predictions, each scaled with its own factors, in one table."""
    parts = [
        apply_factors(predictions, factors, value).select("date_time", "x", "y", "pred")
        for predictions, factors in vintages
    ]
    return reduce(DataFrame.unionByName, parts)


def factors_at_sensors(
    cross_sections: DataFrame,
    reprojection: DataFrame,
    sensor_map: DataFrame,
    factors: DataFrame,
    unmatched: str = "null",
) -> DataFrame:
    """Factor of the cell each sensor lies in; NULL where the cell has none.

    Cross sections that lead to no known sensor give a row of NULLs, or with ``unmatched="drop"``
    none.
    """
    if unmatched not in ("null", "drop"):
        raise ValueError(f"unmatched must be 'null' or 'drop', not {unmatched!r}")
    sensors = sensor_map.select(
        F.col("det_x").alias("x"), F.col("det_y").alias("y"), "stadt_x", "stadt_y"
    )
    by_cell = factors.select(
        F.col("x").alias("stadt_x"), F.col("y").alias("stadt_y"), "scaling"
    )
    placed = reprojection.select("lat_int", "lon_int", F.col("x").alias("at_x"), F.col("y").alias("at_y"))
    found = (
        cross_sections.select("lat_int", "lon_int")
        .distinct()
        .join(placed, ["lat_int", "lon_int"], "left")
        .join(sensors, (F.col("at_x") == F.col("x")) & (F.col("at_y") == F.col("y")), "left")
        .join(by_cell, ["stadt_x", "stadt_y"], "left")
        .select("x", "y", "scaling")
        .distinct()
    )
    return found.filter("x IS NOT NULL") if unmatched == "drop" else found
