"""Hold-outs and folds. A split is a label column, so nothing is copied or moved."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.functions.expressions import md5_bucket

# --- Fixed values -----------------------------------------------------------------------------
HOLD_OUT_WEEKS = 12
HOURS_PER_WEEK = 168
TIME_FOLDS = 4
SPATIAL_FOLDS = 5
SPATIAL_FOLDS_DEV = 2
# ----------------------------------------------------------------------------------------------


def avg_sensors_per_hour(
    df: DataFrame, ts: str = "date_time", place: Sequence[str] = ("x", "y")
) -> DataFrame:
    """Mean over the hours of the number of distinct places seen in the hour."""
    return (
        df.select(ts, *place)
        .distinct()
        .groupBy(ts)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.avg("n").alias("avg_sensors"))
    )


def _weeks(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(7 * n))


def temporal_split(
    df: DataFrame, ts: str = "date_time", weeks: int = HOLD_OUT_WEEKS, label: str = "split"
) -> DataFrame:
    """Label the last ``weeks`` weeks before the latest time "test" and the rest "train"."""
    last = df.agg(F.max(ts).alias("last")).scalar()
    return df.withColumn(label, F.when(F.col(ts) <= last - _weeks(weeks), "train").otherwise("test"))


def _label(in_train: Column, in_test: Column) -> Column:
    return F.when(in_train, "train").when(in_test, "test").otherwise("unused")


def time_folds(
    df: DataFrame,
    ts: str = "date_time",
    weeks: int = HOLD_OUT_WEEKS,
    n_folds: int = TIME_FOLDS,
    prefix: str = "fold_",
) -> DataFrame:
    """Growing training window cut at times: fold i tests on one block of ``weeks`` weeks and
    trains on everything before it; the last block ends at the latest time."""
    last = df.agg(F.max(ts).alias("last")).scalar()
    labels = {}
    for i in range(1, n_folds + 1):
        stop = last - _weeks(weeks * (n_folds - i + 1))
        end = last - _weeks(weeks * (n_folds - i))
        labels[f"{prefix}{i}"] = _label(F.col(ts) <= stop, F.col(ts) <= end)
    return df.withColumns(labels)


def row_folds(
    df: DataFrame,
    tie: Sequence[str],
    ts: str = "date_time",
    place: Sequence[str] = ("x", "y"),
    weeks: int = HOLD_OUT_WEEKS,
    n_folds: int = TIME_FOLDS,
    block_rows: int | None = None,
    prefix: str = "fold_",
) -> DataFrame:
    """Growing training window cut at row positions in time and place order.

    With b rows per block (``weeks`` of hours times the rounded mean number of sensors) and n rows,
    training stops at n − k·b, then every b + 1 rows while a whole test block still fits. That
    gives k − 1 folds for k blocks; one that does not fit has no rows. ``tie`` must make a row unique; ties in time and place are
    ordered by its md5.

    The rows are neither sorted nor numbered. Counts per day, then per time inside the days that a
    cut falls into, then per place and hash slice inside the times that it falls into, locate the
    few rows at the cuts; their keys, two per fold, are fetched, and the labels are plain
    comparisons with them.
    """
    order = [ts, *place]
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in tie]))
    keyed = df.withColumn("_digest", digest).withColumn("_slice", F.substring("_digest", 1, 2))
    group = [*order, "_slice"]

    n = df.count()
    if block_rows is None:
        mean = avg_sensors_per_hour(df, ts, place).first()["avg_sensors"] or 0.0
        block_rows = weeks * HOURS_PER_WEEK * round(mean)
    stops = [n - n_folds * block_rows + i * (block_rows + 1) for i in range(n_folds - 1)]
    fitting = [s for s in stops if s >= 1 and s + block_rows <= n]
    positions = sorted({p for s in fitting for p in (s, s + block_rows)})

    cut_groups = _cut_groups(keyed, ts, group, positions)

    key = [*order, "_digest", *tie]
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_digest", *tie))
    cut_rows = (
        keyed.join(F.broadcast(cut_groups), group)  # at most two groups per fold
        .withColumn("_position", F.col("_start") + rank)
        .filter(F.col("_position").isin(positions))
        .select("_position", *[F.col(c).cast("string").alias(c) for c in key])
    )
    types = dict(keyed.dtypes)
    cuts = {
        row["_position"]: F.struct(*[F.lit(row[c]).cast(types[c]).alias(c) for c in key])
        for row in cut_rows.collect()
    }
    here = F.struct(*key)
    labels = {
        f"{prefix}{i}": _label(here <= cuts[s], here <= cuts[s + block_rows])
        if s in fitting
        else F.lit("unused")
        for i, s in enumerate(stops, 1)
    }
    return keyed.withColumns(labels).drop("_digest", "_slice")


def _cut_groups(keyed: DataFrame, ts: str, group: Sequence[str], positions: Sequence[int]) -> DataFrame:
    """The groups (time, place, slice) that hold one of the positions, with the rows before them.

    Narrowed in three steps, each over the part that the one before left: all days, of which a
    calendar bounds the number, the times of at most a day for each position, and the groups of
    at most a time for each position.
    """

    def holding(counts: DataFrame, window, start: str, base: str | None = None) -> DataFrame:
        before = F.coalesce(
            F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
        counts = counts.withColumn(start, before if base is None else F.col(base) + before)
        held = [(F.col(start) < p) & (F.col(start) + F.col("_n") >= p) for p in positions]
        return counts.filter(reduce(or_, held, F.lit(False)))

    def counted(df: DataFrame, *names: str) -> DataFrame:
        return df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))

    dated = keyed.withColumn("_day", F.to_date(ts))
    days = holding(counted(dated, "_day"), Window.orderBy("_day"), "_day_start")
    inside = dated.join(F.broadcast(days.drop("_n")), "_day")  # a row per position
    of_day = Window.partitionBy("_day").orderBy(ts)
    times = holding(counted(inside, "_day", "_day_start", ts), of_day, "_time_start", "_day_start")
    inside = keyed.join(F.broadcast(times.select(ts, "_time_start")), ts)  # a row per position
    of_time = Window.partitionBy(ts).orderBy(*group[1:])
    found = holding(counted(inside, *group, "_time_start"), of_time, "_start", "_time_start")
    return found.select(*group, "_start")


def expanding_folds(df: DataFrame, mode: str = "time", **options) -> DataFrame:
    """Growing-window folds, cut at times (``mode="time"``) or at row positions (``"rows"``)."""
    if mode == "time":
        return time_folds(df, **options)
    if mode == "rows":
        return row_folds(df, **options)
    raise ValueError(f"mode must be 'time' or 'rows', not {mode!r}")


def group_folds(
    df: DataFrame, key: str = "mq_name", n_folds: int = SPATIAL_FOLDS, seed: int = 0, label: str = "fold"
) -> DataFrame:
    """Put all rows of one ``key`` into one of ``n_folds`` folds, by hash."""
    return df.withColumn(label, md5_bucket([key], seed, n_folds))
