"""The full run: fit on all data, describe the model, score all targets, calibrate, publish."""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sensorgrid.functions.timeparts import LOCAL_TZ, TimeRange
from sensorgrid.operators import features as ft
from sensorgrid.operators.boosting import BoostedModel, fit_boosted, predict, save_model
from sensorgrid.operators.calibrate import calibration_factors
from sensorgrid.operators.evaluate import regression_metrics
from sensorgrid.operators.model import BoostParams, FeatureSpec, best_params, feature_spec
from sensorgrid.operators.scoring import score, score_backfill
from sensorgrid.sources.registry import describe_model, resolve_model_id, set_final_model
from sensorgrid.sources.tables import Table, completeness_check, truncate, upsert_latest

log = logging.getLogger(__name__)

# --- Fixed values: periods scored -------------------------------------------------------------
CALIBRATION_YEAR = 2019
STATIONS_SINCE = "2015-01-01"
PASSIVE_SAMPLER_YEAR = 2022
HOTSPOT_PERIOD = ("2021-11-01 00:00:00", "2022-10-31 23:59:59")
CALIBRATED_TARGET = "q_kfz"
# ----------------------------------------------------------------------------------------------

Sides = Sequence[tuple[DataFrame, Mapping[str, str]]]


class IncompleteError(RuntimeError):
    """Fewer or more predictions arrived than cells × hours."""


@dataclass
class Inputs:
    calendar: DataFrame
    cells: DataFrame
    sensor_map: DataFrame
    stations: DataFrame
    sides: Sides
    volume: DataFrame
    tz: str = LOCAL_TZ


@dataclass(frozen=True)
class Outputs:
    at_sensors: Table
    at_stations: Table
    on_grid: Table
    on_grid_year: Table
    descriptions: Table
    final_models: Table
    scaling: Table
    models: str | None = None  # folder of the models by id


@dataclass
class Run:
    model: BoostedModel
    model_id: int
    in_sample: Row


def check_complete(
    predictions: DataFrame, cells: DataFrame, hours: int | DataFrame, slack: Sequence[int] = (0,)
) -> None:
    row = completeness_check(predictions, cells, hours, slack).first()
    if not row["all_preds_arrived"]:
        raise IncompleteError(f"{row['n']} rows for {row['cells']} cells and {row['hours']} hours")


def refresh_calibration(
    inputs: Inputs,
    model: BoostedModel,
    model_id: int,
    year_table: Table,
    scaling: Table,
    period: TimeRange | None = None,
    chunk_size: float = math.inf,
) -> None:
    """Score the calibration year, check it, renew the factors, and clear the year's table."""
    spark = inputs.cells.sparkSession
    period = period or TimeRange.local_year(CALIBRATION_YEAR, inputs.tz)
    truncate(spark, year_table)
    score_backfill(
        ft.grid_locations(inputs.cells), inputs.calendar, inputs.sides, model, model_id,
        year_table, period, chunk_size, tz=inputs.tz,
    )
    year = year_table.read(spark)
    hours = inputs.calendar.filter(period.predicate("date_time"))
    check_complete(year, inputs.cells, hours)
    upsert_latest(calibration_factors(inputs.volume, year), scaling)
    truncate(spark, year_table)


def calibrate_and_predict(
    train: DataFrame,
    inputs: Inputs,
    outputs: Outputs,
    target: str,
    model_name: str,
    as_of: datetime,
    spec: FeatureSpec | None = None,
    params: BoostParams | None = None,
    chunk_size: float = math.inf,
    dry_run: bool = False,
    seed: int = 0,
) -> Run:
    """Fit ``target`` on ``train`` and publish its predictions.

    Scores the sensors from the model's last stored hour on, the stations from the start of the
    records, and the grid from yesterday to sixteen weeks ahead; for the count target it also
    renews the calibration factors. The model is kept under its id before anything is scored.
    ``dry_run`` writes nothing at all, the description included.
    """
    spark = train.sparkSession
    spec, params = spec or feature_spec(target), params or best_params(target)
    model = fit_boosted(train, spec, params, seed=seed)
    in_sample = regression_metrics(predict(train, model), spec.target, "pred").first()
    log.info("%s in sample: %s", target, in_sample)

    described = resolve_model_id(
        describe_model(train, spec, params, model_name), outputs.descriptions.read(spark)
    )
    model_id = described.first()["model_id"]
    described = described.withColumn("model_id", F.lit(model_id).cast("bigint"))
    upsert_latest(described, outputs.descriptions, dry_run)
    if outputs.models and not dry_run:
        save_model(spark, model, f"{outputs.models}/{model_id}")

    ahead = ft.incremental_scan(
        inputs.calendar,
        outputs.at_sensors.read(spark),
        upper=TimeRange.until(as_of, tz=inputs.tz),
        key={"model_id": model_id},
    )
    at_sensors = ft.feature_frame(
        ft.sensor_locations(inputs.cells, inputs.sensor_map), ahead, inputs.sides, tz=inputs.tz
    )
    score(at_sensors, model, model_id, outputs.at_sensors, dry_run)
    at_stations = ft.feature_frame(
        ft.mapped_locations(inputs.stations), inputs.calendar, inputs.sides,
        TimeRange.since(STATIONS_SINCE, as_of, tz=inputs.tz), tz=inputs.tz,
    )
    score(at_stations, model, model_id, outputs.at_stations, dry_run)

    period = TimeRange.around_today(as_of, tz=inputs.tz)
    score_backfill(
        ft.grid_locations(inputs.cells), inputs.calendar, inputs.sides, model, model_id,
        outputs.on_grid, period, chunk_size, dry_run, all_places=True, tz=inputs.tz,
    )
    if dry_run:
        return Run(model, model_id, in_sample)
    arrived = outputs.on_grid.read(spark).filter(F.col("model_id") == model_id)
    arrived = arrived.filter(period.predicate("date_time"))
    check_complete(arrived, inputs.cells, inputs.calendar.filter(period.predicate("date_time")))
    set_final_model(spark, outputs.final_models, target, model_id)
    if target == CALIBRATED_TARGET:
        refresh_calibration(
            inputs, model, model_id, outputs.on_grid_year, outputs.scaling, chunk_size=chunk_size
        )
    return Run(model, model_id, in_sample)


def hotspot_predictions(
    inputs: Inputs, model: BoostedModel, model_id: int, table: Table, chunk_size: float = math.inf
) -> None:
    """One-off: the grid over the twelve months of the hotspot study."""
    period = TimeRange.closed(*HOTSPOT_PERIOD, inputs.tz)
    score_backfill(
        ft.grid_locations(inputs.cells), inputs.calendar, inputs.sides, model, model_id,
        table, period, chunk_size, tz=inputs.tz,
    )


def passive_sampler_predictions(
    inputs: Inputs, samplers: DataFrame, model: BoostedModel, model_id: int, table: Table
) -> None:
    """One-off: the cells with passive samplers over their year."""
    frame = ft.feature_frame(
        ft.mapped_locations(samplers), inputs.calendar, inputs.sides,
        TimeRange.local_year(PASSIVE_SAMPLER_YEAR, inputs.tz), tz=inputs.tz,
    )
    score(frame, model, model_id, table)
