"""Scoring runs: predictions for locations × hours, written by key."""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.functions.expressions import round_half_even
from sensorgrid.functions.timeparts import TimeRange
from sensorgrid.operators.boosting import BoostedModel, predict
from sensorgrid.operators.features import feature_frame
from sensorgrid.session import small_side
from sensorgrid.sources.tables import MONTH, Table, append, replace_partitions, rewrite_without, upsert_latest

log = logging.getLogger(__name__)

PREDICTION_COLUMNS = ("model_id", "date_time", "x", "y", "value")


def prepare_predictions(df: DataFrame, model_id: int | None = None) -> DataFrame:
    """Predictions as stored: rounded half to even, with the model id if given, in fixed order.

    Columns that ``df`` lacks are left out.
    """
    df = df.withColumn("value", round_half_even("value"))
    if model_id is None:
        df = df.drop("model_id")
    else:
        df = df.withColumn("model_id", F.lit(model_id).cast("bigint"))
    return df.select(*[c for c in PREDICTION_COLUMNS if c in df.columns])


def chunk_keys(
    df: DataFrame, key: str, chunk_length: float, order_by: str | None = None
) -> DataFrame:
    """Cut a list of keys, in the order of ``order_by``, into chunks of at most ``chunk_length``.

    Returns (chunk, keys), the keys of a chunk as text "3, 6". Chunks count from 1; an infinite
    length gives the single chunk 0. Made for coordinate lists, which the grid's width bounds.
    """
    position = F.row_number().over(Window.orderBy(order_by or key))
    length = None if math.isinf(chunk_length) else int(chunk_length)
    chunk = F.lit(0) if length is None else F.ceil(F.col("_position") / length)
    listed = F.array_sort(F.collect_list(F.struct("_position", F.col(key).cast("string").alias("key"))))
    return (
        df.withColumn("_position", position)
        .groupBy(chunk.cast("int").alias("chunk"))
        .agg(F.array_join(F.transform(listed, lambda s: s["key"]), ", ").alias("keys"))
    )


def score_frame(features: DataFrame, model: BoostedModel, model_id: int | None = None) -> DataFrame:
    """Predictions for a feature frame, as stored. One lazy plan from scan to result."""
    return prepare_predictions(predict(features, model, out="value"), model_id)


def score(
    features: DataFrame, model: BoostedModel, model_id: int, table: Table, dry_run: bool = False
) -> None:
    """Predict a feature frame and replace the stored rows of the same keys."""
    upsert_latest(score_frame(features, model, model_id), table, dry_run)


def _stored_near(model_id: int, hours: DataFrame, table: Table) -> DataFrame:
    """A model's stored rows in the months of ``hours``.

    The months are broadcast, few as they are: a shuffle by them would bring all rows of a month
    into one task.
    """
    stored = table.scan(hours.sparkSession).filter(F.col("model_id") == model_id)
    if MONTH in table.partition_by:
        when = F.col("date_time")
        months = hours.select((F.year(when) * 100 + F.month(when)).cast("int").alias(MONTH)).distinct()
        stored = stored.join(F.broadcast(months), MONTH, "left_semi")
    return stored


def _replace(
    new: DataFrame, locations: DataFrame, hours: DataFrame, model_id: int, table: Table, all_places: bool = False
) -> None:
    """Write a model's rows for all ``locations`` and ``hours`` in place of the stored ones.

    Only partitions that the new rows touch are replaced. Rows of them that this run doesn't
    score, such as hours of a month that the range begins or ends in, are carried over. They are
    found by the hours and the places, not by matching keys of the whole product. With
    ``all_places`` there are no other places, and their rows of these hours go. Hours, places and
    x coordinates are broadcast while they are few, so that the stored rows are not shuffled by
    keys of few values.
    """
    stored = _stored_near(model_id, hours, table)
    if "x" in table.partition_by:
        stored = stored.join(small_side(locations.select("x").distinct()), "x", "left_semi")
    if not stored.isEmpty():
        hours = small_side(hours.select("date_time").distinct())
        places = small_side(locations.select("x", "y").distinct())
        kept = [stored.join(hours, "date_time", "left_anti")]
        if not all_places:
            kept.append(stored.join(hours, "date_time", "left_semi").join(places, ["x", "y"], "left_anti"))
        for rows in kept:
            new = new.unionByName(rows.select(*new.columns))
    replace_partitions(new, table)


def _remove_departed(locations: DataFrame, hours: DataFrame, model_id: int, table: Table) -> None:
    """Take out a model's rows of ``hours`` in partitions by ``x`` where no location is left."""
    stored = _stored_near(model_id, hours, table)
    departed = stored.join(small_side(locations.select("x").distinct()), "x", "left_anti")
    hours = small_side(hours.select("date_time").distinct())
    rewrite_without(departed, departed.join(hours, "date_time", "left_anti"), table)


RUN_SCHEMA = "run_id string, model_id bigint, chunk int, keys string"


def score_backfill(
    locations: DataFrame,
    calendar: DataFrame,
    sides: Sequence[tuple[DataFrame, Mapping[str, str]]],
    model: BoostedModel,
    model_id: int,
    table: Table,
    time_range: TimeRange | None = None,
    chunk_size: float = math.inf,
    dry_run: bool = False,
    run_id: str | None = None,
    all_places: bool = False,
    **frame_options,
) -> int:
    """Score all locations and hours and put them in place of what is stored. Returns the jobs run.

    Every call scores everything anew, so a run after a change of the inputs replaces the values of
    the one before. By default this is one job, spread by location, without a list of coordinates.
    ``chunk_size`` limits how many x coordinates one job takes. With a ``run_id`` each chunk is
    recorded after its commit, beside the table, and a later call of the same run skips the
    recorded ones; nothing else is taken as proof that rows are there. ``model_id`` must be a
    partition column of the table, and ``x`` too if the run is cut into chunks. Rows of other
    places stay, unless ``all_places`` says that ``locations`` are all there are: then the model's
    rows of these hours at any other place, such as a cell that has left the grid, are taken out.
    """
    spark = locations.sparkSession
    needed = {"model_id"} if math.isinf(chunk_size) else {"model_id", "x"}
    if not needed <= set(table.partition_by):
        raise ValueError(f"{table.path}: a backfill replaces partitions by {sorted(needed)}")
    hours = calendar.filter(time_range.predicate("date_time")) if time_range else calendar
    runs = Table(f"{table.path.rstrip('/')}_runs", RUN_SCHEMA, ())
    done = set()
    if run_id is not None:
        recorded = runs.read(spark).filter((F.col("run_id") == run_id) & (F.col("model_id") == model_id))
        done = {(r["chunk"], r["keys"]) for r in recorded.collect()}
    jobs: list[tuple[int, str | None]] = [(0, None)]
    if not math.isinf(chunk_size):
        chunks = chunk_keys(locations.select("x").distinct(), "x", chunk_size)
        jobs = [(r["chunk"], r["keys"]) for r in chunks.orderBy("chunk").collect()]
    jobs = [job for job in jobs if job not in done]
    for chunk, keys in jobs:
        places = locations
        if keys is not None:
            log.info("chunk %s: x in (%s)", chunk, keys)
            places = locations.filter(F.col("x").isin([int(x) for x in keys.split(", ")]))
        frame = feature_frame(places, hours, sides, **frame_options)
        if not dry_run:
            _replace(score_frame(frame, model, model_id), places, hours, model_id, table, all_places)
            if run_id is not None:
                append(spark.createDataFrame([(run_id, model_id, chunk, keys)], RUN_SCHEMA), runs)
    if all_places and "x" in table.partition_by and not dry_run:
        _remove_departed(locations, hours, model_id, table)
    return len(jobs)
