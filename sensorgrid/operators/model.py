"""Model configuration: features, targets, stored parameters and the random grid."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.functions.expressions import md5_fraction

# --- Fixed values: targets, predictors in order, tuned parameters, search ranges ---------------
TARGETS = ("q_kfz", "v_kfz")
PREDICTORS = (
    "x", "y", "year", "day_of_week", "day_of_year", "hour", "winter_time",
    "summer_holidays", "other_school_holidays", "is_public_holiday",
    "str_class_0", "str_class_I", "str_class_II", "str_class_III", "str_class_IV", "str_class_V",
    "land_water", "land_grey", "land_green", "land_infra", "land_mixed", "land_forest",
    "land_living",
    "building_density", "building_height",
    "traffic_volume",
)
BEST_VALUES = {
    "q_kfz": dict(nrounds=303, max_depth=9, eta=0.3048174, gamma=1.588561,
                  colsample_bytree=0.8311579, min_child_weight=1, subsample=0.8877896,
                  reg_lambda=500000.0),
    "v_kfz": dict(nrounds=117, max_depth=10, eta=0.1250001, gamma=8.474384,
                  colsample_bytree=0.7686541, min_child_weight=12, subsample=0.9978663,
                  reg_lambda=5.0),
}
GRID_ROUNDS = 500
GRID_DEPTH = (7, 10)
GRID_ETA = (0.001, 0.6)
GRID_GAMMA = (0.0, 10.0)
GRID_COLSAMPLE = (0.7, 1.0)
GRID_CHILD_WEIGHT = (0, 20)
GRID_SUBSAMPLE = (0.7, 1.0)
LAMBDAS = tuple(10.0**k / 2 for k in range(1, 8))
# ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class FeatureSpec:
    """Target column and ordered predictors."""

    target: str
    features: tuple[str, ...] = PREDICTORS

    def formula(self) -> list[str]:
        return ["~", self.target, " + ".join(self.features)]


def _known_target(target: str) -> str:
    if target not in TARGETS:
        raise ValueError(f"target must be one of {TARGETS}, not {target!r}")
    return target


def feature_spec(target: str) -> FeatureSpec:
    return FeatureSpec(_known_target(target))


@dataclass(frozen=True)
class BoostParams:
    """Boosting parameters in the usual meaning for squared error, where a row weighs 1."""

    nrounds: int
    max_depth: int
    eta: float = 0.3
    gamma: float = 0.0
    colsample_bytree: float = 1.0
    min_child_weight: float = 1
    subsample: float = 1.0
    reg_lambda: float = 1.0

    def grid_values(self) -> dict:
        """The searched parameters; the penalty is not one of them."""
        return {k: v for k, v in asdict(self).items() if k != "reg_lambda"}

    def with_(self, **changes) -> BoostParams:
        return replace(self, **changes)

    @classmethod
    def from_row(cls, row, **changes) -> BoostParams:
        names = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in row.asDict().items() if k in names}).with_(**changes)


def best_params(target: str) -> BoostParams:
    """Stored best parameters and penalty of a target."""
    return BoostParams(**BEST_VALUES[_known_target(target)])


def _uniform(name: str, seed: int, low: float, high: float) -> Column:
    return low + md5_fraction(["trial", F.lit(name)], seed) * (high - low)


def _whole(name: str, seed: int, low: int, high: int) -> Column:
    return (low + F.floor(md5_fraction(["trial", F.lit(name)], seed) * (high - low + 1))).cast("int")


def random_grid(spark: SparkSession, tune_length: int, seed: int = 0) -> DataFrame:
    """``tune_length`` random parameter sets; the round limit is meant for early stopping."""
    return (
        spark.range(1, tune_length + 1)
        .withColumnRenamed("id", "trial")
        .select(
            "trial",
            F.lit(GRID_ROUNDS).alias("nrounds"),
            _whole("max_depth", seed, *GRID_DEPTH).alias("max_depth"),
            _uniform("eta", seed, *GRID_ETA).alias("eta"),
            _uniform("gamma", seed, *GRID_GAMMA).alias("gamma"),
            _uniform("colsample_bytree", seed, *GRID_COLSAMPLE).alias("colsample_bytree"),
            _whole("min_child_weight", seed, *GRID_CHILD_WEIGHT).alias("min_child_weight"),
            _uniform("subsample", seed, *GRID_SUBSAMPLE).alias("subsample"),
        )
    )
