"""Model registry: description rows, ids, and the production model per target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorgrid.functions.timeparts import format_timestamp
from sensorgrid.operators.model import BoostParams, FeatureSpec
from sensorgrid.sources.tables import Table, upsert_latest

DESCRIPTION_COLUMNS = ("model_id", "date_time", "model_name", "depvar", "description")


def describe_model(
    train: DataFrame,
    spec: FeatureSpec,
    params: BoostParams,
    model_name: str,
    full: DataFrame | None = None,
    ts: str = "date_time",
) -> DataFrame:
    """One row about a fitted model, with a JSON text of parameters, formula and training dates.

    ``full`` is the data whose latest time dates the model; by default the training data.
    """
    hyperparams = F.struct(*[F.lit(v).alias(k) for k, v in params.grid_values().items()])
    formula = F.array(*[F.lit(part) for part in spec.formula()])
    dates = F.struct(
        format_timestamp(F.min(ts)).alias("train_start"), format_timestamp(F.max(ts)).alias("train_end")
    )
    dated = F.max(ts) if full is None else full.agg(F.max(ts).alias("latest")).scalar()
    description = F.to_json(
        F.struct(
            hyperparams.alias("hyperparams"), formula.alias("model_formula"), dates.alias("dates")
        )
    )
    return train.agg(
        F.lit(None).cast("bigint").alias("model_id"),
        dated.alias("date_time"),
        F.lit(model_name).alias("model_name"),
        F.lit(spec.target).alias("depvar"),
        description.alias("description"),
    )


def resolve_model_id(described: DataFrame, registry: DataFrame) -> DataFrame:
    """Give description rows their ids: that of an equal registered row, else the next free one.

    Rows are equal in time, name and description. New descriptions, which are few, are numbered
    in this order from the highest id on; equal ones share an id. An empty registry starts at 1.
    """
    same = ["date_time", "model_name", "description"]
    known = registry.groupBy(*same).agg(F.min("model_id").alias("_known"))
    highest = registry.agg(F.coalesce(F.max("model_id"), F.lit(0)).alias("n")).scalar()
    wanted = described.drop("model_id").join(known, same, "left")
    fresh = wanted.filter("_known IS NULL").select(*same).distinct()
    number = highest + F.row_number().over(Window.orderBy(*same))
    fresh = fresh.select(*[F.col(c).alias(f"_{c}") for c in same], number.alias("_new"))
    equal = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same]
    return (
        wanted.join(fresh, equal, "left")
        .withColumn("model_id", F.coalesce("_known", "_new").cast("bigint"))
        .select(*described.columns)
    )


def set_final_model(
    spark: SparkSession, table: Table, depvar: str, model_id: int, dry_run: bool = False
) -> None:
    """Point a target to its production model."""
    row = spark.createDataFrame([(depvar, model_id)], "depvar string, model_id bigint")
    upsert_latest(row, table, dry_run)
