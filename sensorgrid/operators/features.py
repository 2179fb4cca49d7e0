"""Training and scoring frames: cell features, location lists, calendars, samples."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorgrid.functions.expressions import md5_fraction, md5_number
from sensorgrid.functions.timeparts import (
    LOCAL_TZ,
    TimeRange,
    other_school_holidays,
    summer_holidays,
    time_part_columns,
)
from sensorgrid.schemas import (
    BUILDING_COLUMNS,
    LAND_USE_COLUMNS,
    STREET_COLUMNS,
    VOLUME_COLUMNS,
    require_columns,
)
from sensorgrid.session import small_side

# --- Fixed values -----------------------------------------------------------------------------
SENTINEL = -1  # a missing count or speed
DEV_SAMPLE_FRACTION = 0.002
# ----------------------------------------------------------------------------------------------

ROWS_PER_TASK = 2_000_000

CELL_SIDES: tuple[Mapping[str, str], ...] = (
    STREET_COLUMNS,
    LAND_USE_COLUMNS,
    VOLUME_COLUMNS,
    BUILDING_COLUMNS,
)
CALENDAR_COLUMNS = ("summer_holidays", "other_school_holidays", "is_public_holiday", "day_of_year")
TIME_COLUMNS = ("day_of_week", "year", "hour", "winter_time")


def cell_features(
    base: DataFrame,
    sides: Sequence[tuple[DataFrame, Mapping[str, str]]],
    on: tuple[str, str] = ("x", "y"),
    unmatched: str = "zero",
) -> DataFrame:
    """Left-join the gridded feature tables onto ``base``.

    ``sides`` holds (table keyed by x and y, {source column: feature name}). ``on`` names the cell
    coordinates in ``base``. Cells missing from a side get 0 or, with ``unmatched="null"``, NULL.
    """
    if unmatched not in ("zero", "null"):
        raise ValueError(f"unmatched must be 'zero' or 'null', not {unmatched!r}")
    out, names = base, []
    for table, columns in sides:
        require_columns(table, ["x", "y", *columns], "cell_features")
        side = table.select(
            F.col("x").alias(on[0]),
            F.col("y").alias(on[1]),
            *[F.col(source).alias(name) for source, name in columns.items()],
        )
        out = out.join(side, list(on), "left")
        names += columns.values()
    if unmatched == "zero":
        out = zero_for_null(out, names)
    return out.select(*base.columns, *names)


def zero_for_null(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """0 in place of NULL. ``fillna`` would also replace NaN, which is data and not a gap."""
    types = dict(df.dtypes)
    return df.withColumns({n: F.coalesce(n, F.lit(0).cast(types[n])) for n in names})


def calendar_features(
    calendar: DataFrame, tz: str = LOCAL_TZ, with_time_parts: bool = True
) -> DataFrame:
    """One row per calendar hour with holiday flags and, if asked, local time parts."""
    require_columns(
        calendar, ["date_time", "type_school_holiday", "is_public_holiday", "doy_scaled"], "calendar"
    )
    parts = time_part_columns("date_time", tz) if with_time_parts else {}
    return calendar.select(
        "date_time",
        *[c.alias(n) for n, c in parts.items()],
        summer_holidays("type_school_holiday").alias("summer_holidays"),
        other_school_holidays("type_school_holiday").alias("other_school_holidays"),
        "is_public_holiday",
        F.col("doy_scaled").alias("day_of_year"),
    )


def training_frame(
    observations: DataFrame,
    calendar: DataFrame,
    sensor_map: DataFrame,
    sides: Sequence[tuple[DataFrame, Mapping[str, str]]],
    targets: Mapping[str, str] | None = None,
    tz: str = LOCAL_TZ,
    unmatched: str = "zero",
    sort: bool = False,
) -> DataFrame:
    """Observations with time, holiday and cell features.

    All cell tables are folded into the sensor map first, so the observations are joined twice
    only: with the calendar and with the sensors. Both sides are broadcast when their counted
    size allows, and then the observations are not shuffled at all.
    """
    targets = targets or {"q_kfz_mq_hr": "q_kfz", "v_kfz_mq_hr": "v_kfz"}
    require_columns(observations, ["mq_name", "date_time", "x", "y", *targets], "observations")
    sensors = cell_features(sensor_map, sides, on=("stadt_x", "stadt_y"), unmatched=unmatched)
    cell_names = [name for _, columns in sides for name in columns.values()]
    sensors = sensors.select(
        F.col("det_x").alias("x"), F.col("det_y").alias("y"), *cell_names
    )
    hours = calendar_features(calendar, tz, with_time_parts=False)
    out = (
        observations.join(small_side(hours), "date_time", "left")
        .join(small_side(sensors), ["x", "y"], "left")
        .withColumns(time_part_columns("date_time", tz))
    )
    if unmatched == "zero":
        out = zero_for_null(out, [*cell_names, "is_public_holiday", "day_of_year"])
    out = out.select(
        "mq_name",
        "date_time",
        *TIME_COLUMNS,
        *[F.col(source).alias(name) for source, name in targets.items()],
        "x",
        "y",
        F.coalesce("summer_holidays", F.lit(False)).alias("summer_holidays"),
        F.coalesce("other_school_holidays", F.lit(False)).alias("other_school_holidays"),
        "is_public_holiday",
        "day_of_year",
        *cell_names,
    )
    return out.orderBy("date_time", "x", "y") if sort else out


def grid_locations(cells: DataFrame) -> DataFrame:
    """Every grid cell, located at itself."""
    return cells.select("x", "y", F.col("x").alias("cell_x"), F.col("y").alias("cell_y"))


def sensor_locations(cells: DataFrame, sensor_map: DataFrame) -> DataFrame:
    """Sensors whose cell is on the grid; one row per mapped sensor."""
    grid = cells.select(F.col("x").alias("cell_x"), F.col("y").alias("cell_y"))
    sensors = sensor_map.select(
        F.col("det_x").alias("x"),
        F.col("det_y").alias("y"),
        F.col("stadt_x").alias("cell_x"),
        F.col("stadt_y").alias("cell_y"),
    )
    return grid.join(sensors, ["cell_x", "cell_y"]).select("x", "y", "cell_x", "cell_y")


def mapped_locations(mapping: DataFrame) -> DataFrame:
    """Stations or passive samplers: listed by the cell they lie in."""
    cells = mapping.select(F.col("stadt_x").alias("x"), F.col("stadt_y").alias("y"))
    return grid_locations(cells)


def locations_by_hours(
    locations: DataFrame, hours: DataFrame, ts: str = "date_time", tasks: int | None = None
) -> DataFrame:
    """Every location at every hour of the calendar.

    Each location is laid out over the days from the first to the last calendar day and then
    equi-joined with the hours of that day. The hours are broadcast while they are few and
    merge-joined otherwise.

    The location days are spread over ``tasks`` tasks before, each with a range of them: a small
    location table would otherwise be one task, and tasks that mix locations would each write a
    file into every partition of a table partitioned by ``x``. By default there are tasks for the
    cores at hand, and more where a task would make over ``ROWS_PER_TASK`` rows.
    """
    n_hours = hours.count()
    if tasks is None:
        wanted = -(-locations.count() * n_hours // ROWS_PER_TASK)
        tasks = max(2 * locations.sparkSession.sparkContext.defaultParallelism, wanted)
    dated = hours.withColumn("_day", F.to_date(ts))
    days = dated.agg(F.sequence(F.min("_day"), F.max("_day")).alias("days")).scalar()
    return (
        locations.withColumn("_day", F.explode(days))
        .repartitionByRange(tasks, "x", "y", "_day")
        .join(small_side(dated, rows=n_hours), "_day")
        .drop("_day")
    )


def feature_frame(
    locations: DataFrame,
    calendar: DataFrame,
    sides: Sequence[tuple[DataFrame, Mapping[str, str]]],
    time_range: TimeRange | None = None,
    x_coords: Iterable[int] | None = None,
    tz: str = LOCAL_TZ,
    unmatched: str = "zero",
    sort: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Scoring frame: locations (x, y, cell_x, cell_y) × hours with the model's features.

    The hours are filtered and their expressions computed before the product, the cell features
    joined to the locations before it, so neither is repeated per output row.
    """
    require_columns(locations, ["x", "y", "cell_x", "cell_y"], "locations")
    if time_range is not None:
        calendar = calendar.filter(time_range.predicate("date_time"))
    if x_coords is not None:
        locations = locations.filter(F.col("x").isin(list(x_coords)))
    hours = calendar_features(calendar, tz)
    if unmatched == "zero":
        hours = zero_for_null(hours, ["is_public_holiday", "day_of_year"])
    placed = cell_features(locations, sides, on=("cell_x", "cell_y"), unmatched=unmatched)
    cell_names = [name for _, columns in sides for name in columns.values()]
    out = locations_by_hours(placed.drop("cell_x", "cell_y"), hours, tasks=tasks).select(
        "date_time", *TIME_COLUMNS, "x", "y", *CALENDAR_COLUMNS, *cell_names
    )
    return out.orderBy("x", "y", F.col("date_time").desc()) if sort else out


def incremental_scan(
    df: DataFrame,
    target: DataFrame,
    ts: str = "date_time",
    target_ts: str = "date_time",
    upper: TimeRange | None = None,
    key: Mapping[str, object] | None = None,
) -> DataFrame:
    """Rows of ``df`` after the latest time in ``target``, up to the end of ``upper``.

    ``key`` restricts the target, for example to one model, so that another model's progress does
    not hide rows. An empty target leaves the lower bound open. The latest time is a scalar
    subquery, and Spark pushes the comparison into the scan.
    """
    for name, value in (key or {}).items():
        target = target.filter(F.col(name) == value)
    floor = F.to_timestamp_ntz(F.lit("0001-01-01 00:00:00"))
    latest = target.agg(F.coalesce(F.max(target_ts), floor).alias("latest")).scalar()
    out = df.filter(F.col(ts) > latest)
    return out.filter(upper.predicate(ts)) if upper else out


def drop_sentinel(df: DataFrame, target: str, sentinel: float = SENTINEL) -> DataFrame:
    """Keep rows whose target is known. NULL goes as well."""
    return df.filter(F.col(target) != sentinel)


def hash_sample(df: DataFrame, fraction: float, key: Sequence[str], seed: int = 0) -> DataFrame:
    """About ``fraction`` of the rows, decided by a hash of ``key``: repeatable, no shuffle."""
    return df.filter(md5_fraction(key, seed) < fraction)


def sample_n(
    df: DataFrame, n: int | Column, key: Sequence[str], seed: int = 0
) -> DataFrame:
    """Exactly ``n`` rows (all rows if there are fewer), the ones with the smallest hash of ``key``.

    A histogram of the leading 16 hash bits finds the slice that holds the n-th row. Rows in lower
    slices are taken by a filter where they lie; only the rows of that one slice are ranked. The
    sample is never gathered in one place. ``key`` should identify a row.
    """
    hashed = df.withColumn("_hash", md5_number(key, seed))
    hashed = hashed.withColumn("_slice", F.shiftright("_hash", 16))
    counts = hashed.groupBy("_slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # <= 65,536 rows
    wanted = F.lit(n) if isinstance(n, int) else n
    edge = (
        counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .filter((F.col("before") < wanted) & (F.col("before") + F.col("n") >= wanted))
        .agg(
            F.coalesce(F.max("_slice"), F.lit(2**16)).alias("slice"),
            F.coalesce(wanted - F.max("before"), F.lit(0)).alias("rest"),
        )
        .select(F.struct("slice", "rest").alias("edge"))
        .scalar()
    )
    whole = hashed.filter((F.col("_slice") < edge["slice"]) & (wanted > 0))
    rank = F.row_number().over(
        Window.partitionBy("_slice").orderBy("_hash", *[F.col(k) for k in key])
    )
    part = (
        hashed.filter(F.col("_slice") == edge["slice"])
        .withColumn("_rank", rank)
        .filter(F.col("_rank") <= edge["rest"])
        .drop("_rank")
    )
    return whole.unionByName(part).drop("_hash", "_slice")


def sample_fraction(df: DataFrame, fraction: float, key: Sequence[str], seed: int = 0) -> DataFrame:
    """A share of the rows, exact in size."""
    size = df.agg(F.rint(F.count(F.lit(1)) * fraction).cast("bigint").alias("n")).scalar()
    return sample_n(df, size, key, seed)


def snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` and go on from the stored copy."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def training_data(
    spark: SparkSession,
    frame: DataFrame | str,
    target: str,
    dev: bool = False,
    fraction: float = DEV_SAMPLE_FRACTION,
    key: Sequence[str] = ("mq_name", "date_time"),
    seed: int = 0,
    sort: bool = False,
) -> DataFrame:
    """Rows to fit ``target`` on, from a frame or the path of a snapshot.

    ``dev`` takes an exact share of the rows. ``sort`` brings them in time and place order, which
    no operator here needs: row-based folds find their cuts without it.
    """
    data = spark.read.parquet(frame) if isinstance(frame, str) else frame
    data = drop_sentinel(data, target)
    if dev:
        data = sample_fraction(data, fraction, key, seed)
    return data.orderBy("date_time", "x", "y") if sort else data
