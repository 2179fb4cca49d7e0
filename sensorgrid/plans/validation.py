"""Validation over time (with tuning) and over space."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sensorgrid.operators import evaluate, splits
from sensorgrid.operators.boosting import (
    BoostedModel,
    best_trial,
    fit_boosted,
    lambda_sweep,
    predict,
    search,
    search_results,
    spatial_cv,
)
from sensorgrid.operators.calibrate import apply_factors
from sensorgrid.operators.model import (
    LAMBDAS,
    BoostParams,
    FeatureSpec,
    best_params,
    feature_spec,
    random_grid,
)
from sensorgrid.plans.calibration import CALIBRATED_TARGET
from sensorgrid.session import Stage, cut_lineage

# --- Fixed values -----------------------------------------------------------------------------
TUNE_LENGTH = 25
TUNE_LENGTH_DEV = 2
# ----------------------------------------------------------------------------------------------


@dataclass
class TemporalResult:
    """``trials`` and ``sweep`` replace a hand-made copy of the best values."""

    trials: DataFrame
    best_cv: DataFrame
    in_sample: Row
    out_of_sample: Row
    sweep: DataFrame
    best_lambda: float
    model: BoostedModel


def temporal_validation(
    df: DataFrame,
    target: str,
    spec: FeatureSpec | None = None,
    grid: DataFrame | None = None,
    lambdas: Sequence[float] = LAMBDAS,
    tune_length: int = TUNE_LENGTH,
    ts: str = "date_time",
    weeks: int = splits.HOLD_OUT_WEEKS,
    n_folds: int = splits.TIME_FOLDS,
    seed: int = 0,
) -> TemporalResult:
    """Hold out the last weeks, search on growing folds before them, sweep the penalty, refit.

    The hold-out serves as watch data throughout, so its errors flatter the final model somewhat.
    """
    spec = spec or feature_spec(target)
    grid = grid if grid is not None else random_grid(df.sparkSession, tune_length, seed)
    stage = Stage(df.sparkSession, "temporal")
    labelled = stage.put(splits.temporal_split(df, ts, weeks))
    train = labelled.filter(F.col("split") == "train")
    test = labelled.filter(F.col("split") == "test")
    folded = splits.time_folds(train, ts, weeks, n_folds)
    folds = [f"fold_{i}" for i in range(1, n_folds + 1)]

    trials = search(folded, spec, grid, folds, validation=test, seed=seed)
    best = best_trial(trials)
    params = BoostParams.from_row(best.first())
    model = fit_boosted(train, spec, params, test, seed=seed)
    in_sample = evaluate.regression_metrics(predict(train, model), spec.target, "pred").first()
    out_of_sample = evaluate.regression_metrics(predict(test, model), spec.target, "pred").first()

    sweep = lambda_sweep(train, test, spec, params, lambdas, seed=seed)
    best_lambda = best_trial(sweep, "rmse_oos", "lambda").first()["lambda"]
    final = fit_boosted(train, spec, params.with_(reg_lambda=best_lambda), test, seed=seed)
    best_cv = search_results(best.select("trial", *params.grid_values()), trials)
    stage.clear()
    return TemporalResult(trials, best_cv, in_sample, out_of_sample, sweep, best_lambda, final)


@dataclass
class SpatialResult:
    predictions: DataFrame
    per_fold: DataFrame
    mean: DataFrame
    per_sensor: DataFrame
    correlation: DataFrame


def spatial_validation(
    df: DataFrame,
    factors: DataFrame,
    target: str,
    spec: FeatureSpec | None = None,
    params: BoostParams | None = None,
    n_folds: int = splits.SPATIAL_FOLDS,
    sensor: str = "mq_name",
    seed: int = 0,
) -> SpatialResult:
    """Predict each sensor with a model that has not seen it. Counts are scaled with the factor of
    the sensor's cell and halved, because the factors belong to both directions of a road."""
    spec, params = spec or feature_spec(target), params or best_params(target)
    stage = Stage(df.sparkSession, "spatial")
    folded = stage.put(splits.group_folds(df, sensor, n_folds, seed))
    predicted = spatial_cv(folded, spec, params, range(1, n_folds + 1), seed=seed)
    if target == CALIBRATED_TARGET:
        predicted = apply_factors(predicted, factors, value="pred", out="pred", how="left", divisor=2)
    else:
        predicted = predicted.join(factors.select("x", "y", "scaling"), ["x", "y"], "left")
    predicted = cut_lineage(predicted)  # part of the result
    stage.clear()
    per_fold = evaluate.metrics_by_group(predicted, "fold", spec.target, "pred")
    per_sensor = evaluate.sensor_summary(
        predicted, spec.target, "pred", sensor=sensor, scaling="scaling"
    )
    return SpatialResult(
        predicted,
        per_fold,
        evaluate.mean_metrics(per_fold),
        per_sensor,
        evaluate.sensor_correlation(per_sensor),
    )


def store_result(frame: DataFrame, path: str, run_id: str) -> None:
    """Keep a table of a validation or explanation run under its id; a repeated run replaces it."""
    writer = frame.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def store_temporal(result: TemporalResult, root: str, run_id: str) -> None:
    """Trials, the best trial's errors, and the penalty sweep."""
    for name in ("trials", "best_cv", "sweep"):
        store_result(getattr(result, name), f"{root}/{name}", run_id)


def store_spatial(result: SpatialResult, root: str, run_id: str) -> None:
    """Predictions of rows that the models had not seen, and their errors."""
    for name in ("predictions", "per_fold", "mean", "per_sensor", "correlation"):
        store_result(getattr(result, name), f"{root}/{name}", run_id)
