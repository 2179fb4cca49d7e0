"""Nearest grid cells, street matching, and predictions at manual counting points."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.functions.expressions import (
    DEGREE_SCALE,
    contains_name,
    degrees,
    haversine,
    metres,
)
from sensorgrid.functions.timeparts import LOCAL_TZ, TimeRange
from sensorgrid.operators.calibrate import scaled_union
from sensorgrid.operators.features import ROWS_PER_TASK
from sensorgrid.session import cut_lineage, small_side

# Tiles of 2^22 fixed-point units (about 42 degrees) and, where a tile holds more than ``TILE_CELLS``
# cells, its parts of a quarter the side, down to one unit. The whole globe has 5 × 9 top tiles.
TILE_CELLS = 16
POINTS_PER_TASK = 50_000
_TOP, _STEP = 22, 2
_LEVELS = range(_TOP, -1, -_STEP)
_TOP_ROWS = (180 * DEGREE_SCALE >> _TOP) + 1
_TOP_COLS = (360 * DEGREE_SCALE >> _TOP) + 1
_SLACK_M = 0.01  # keeps every cell that could win after rounding to millimetres

# Least and greatest possible haversine from (lat, lon) to a cell of a box. Each factor is bounded
# by itself: the latitude gap, the longitude gap around the globe, the cosine of the cell's latitude.
_NEAR = """
    pow(sin(radians(greatest(lat_lo - lat, lat - lat_hi, 0D)) / 2), 2)
    + cos(radians(lat)) * least(cos(radians(lat_lo)), cos(radians(lat_hi)))
    * pow(sin(radians(CASE WHEN lon BETWEEN lon_lo AND lon_hi THEN 0D
        ELSE least(abs(lon - lon_lo), 360 - abs(lon - lon_lo),
                   abs(lon - lon_hi), 360 - abs(lon - lon_hi)) END) / 2), 2)"""
_FAR = """
    pow(sin(radians(greatest(abs(lat - lat_lo), abs(lat - lat_hi))) / 2), 2)
    + cos(radians(lat))
    * CASE WHEN lat_lo <= 0 AND lat_hi >= 0 THEN 1D
           ELSE greatest(cos(radians(lat_lo)), cos(radians(lat_hi))) END
    * pow(sin(radians(least(greatest(abs(lon - lon_lo), abs(lon - lon_hi)), 180D)) / 2), 2)"""


def _quadtree(cells: DataFrame, tile_cells: int) -> tuple[DataFrame, DataFrame]:
    """Cells with the tile they end in (leaf level, row, col), and the tiles of all levels.

    A tile has its place, the extent of its cells in degrees, and ``leaf``: whether its cells are
    few enough, or all at one place, to be looked at one by one. Only larger tiles have parts. The
    tiles are counted at all levels in one pass, combined before the shuffle, and of cells at one
    place only the smallest is kept, which is the one that can be nearest.
    """
    ends = [
        agg(degrees(f"{c}_int")).alias(f"{c}_{end}")
        for c in ("lat", "lon") for end, agg in (("lo", F.min), ("hi", F.max))
    ]
    spots = cells.groupBy("lat_int", "lon_int").agg(F.min(F.struct("x", "y")).alias("cell"))
    spots = cut_lineage(spots.select("cell.x", "cell.y", "lat_int", "lon_int"))
    placed = spots.withColumn("level", F.explode(F.array(*[F.lit(n) for n in _LEVELS]))).select(
        "*",
        F.expr(f"shiftright(lat_int + {90 * DEGREE_SCALE}, level)").alias("row"),
        F.expr(f"shiftright(lon_int + {180 * DEGREE_SCALE}, level)").alias("col"),
    )
    counted = placed.groupBy("level", "row", "col").agg(F.count(F.lit(1)).alias("n"), *ends)
    whole = F.col("n") <= tile_cells
    counted = cut_lineage(counted.select("*", (whole | (F.col("level") == 0)).alias("leaf")))
    parted = counted.filter("NOT leaf").selectExpr(f"level - {_STEP} AS level", "row AS up_row", "col AS up_col")
    up = [F.shiftright(c, _STEP).alias(f"up_{c}") for c in ("row", "col")]
    tiles = counted.drop("n").select("*", *up)
    top = tiles.filter(F.col("level") == _TOP)
    tiles = cut_lineage(top.unionByName(tiles.join(parted, ["level", "up_row", "up_col"], "left_semi")))
    ends_in = small_side(tiles.filter("leaf").select("level", "row", "col"))
    return cut_lineage(placed.join(ends_in, ["level", "row", "col"])), tiles


def nearest_cell(points: DataFrame, cells: DataFrame, tile_cells: int = TILE_CELLS) -> DataFrame:
    """Nearest cell of every point by great-circle distance; ties go to the smallest (x, y).

    ``points`` has ``lat``, ``lon`` in degrees, ``cells`` has ``x, y, lat_int, lon_int``. Adds
    ``x``, ``y`` and ``dist_m`` (rounded to millimetres) to the points. A point without a position
    stays, with NULLs, and so do all points if there are no cells.

    Exact search from coarse to fine tiles of a quadtree that is as deep as the cells are crowded:
    at each level a tile stays in the running for a point only if its nearest possible cell is not
    beyond the farthest possible cell of the best tile. All steps are equi-joins on tiles. A point
    meets the cells of a few leaves, of at most ``tile_cells`` cells each, and points at one position
    are searched once. Each level takes up the one before it a single time.
    """
    located = cells.select("x", "y", "lat_int", "lon_int").filter("lat_int IS NOT NULL AND lon_int IS NOT NULL")
    leaves, tiles = _quadtree(located, tile_cells)
    levels = sorted((r["level"] for r in tiles.select("level").distinct().collect()), reverse=True)
    at_place = Window.partitionBy("lat", "lon")
    positions = points.select("lat", "lon").filter("lat IS NOT NULL AND lon IS NOT NULL").distinct()
    positions = cut_lineage(positions)
    tasks = max(2 * points.sparkSession.sparkContext.defaultParallelism, -(-positions.count() // POINTS_PER_TASK))
    running = (
        positions.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(_TOP_ROWS * _TOP_COLS - 1))))
        .selectExpr("lat", "lon", f"{_TOP} AS to_level", f"tile DIV {_TOP_COLS} AS to_row", f"bigint(tile % {_TOP_COLS}) AS to_col")
    )
    place = ["to_level", "to_row", "to_col"]
    extent = ["lat_lo", "lat_hi", "lon_lo", "lon_hi"]
    for level in levels:
        # a tile of this level is met from the tile it is a part of, a leaf above from itself
        here = tiles.filter(F.col("level") == level)
        above = tiles.filter(f"level > {level} AND leaf").selectExpr(
            "level AS to_level", "row AS to_row", "col AS to_col", "level", "row", "col", "leaf", *extent
        )
        source = f"{_TOP} AS to_level, row AS to_row, col AS to_col" if level == _TOP else (
            f"{level + _STEP} AS to_level, up_row AS to_row, up_col AS to_col"
        )
        ways = here.selectExpr(*source.split(", "), "level", "row", "col", "leaf", *extent).unionByName(above)
        met = running.join(small_side(ways), place).select(
            "lat", "lon", "level", "row", "col",
            metres(F.expr(_NEAR)).alias("near"), metres(F.expr(_FAR)).alias("far"),
        )
        if level == _TOP:  # from here on a position stays in its task while tiles and leaves are broadcast
            met = met.repartition(tasks, "lat", "lon")
        running = (
            met.withColumn("best", F.min("far").over(at_place))
            .filter(F.col("near") <= F.col("best") + _SLACK_M)
            .selectExpr("lat", "lon", "level AS to_level", "row AS to_row", "col AS to_col")
        )

    distance = metres(
        haversine(F.col("lat"), F.col("lon"), degrees("lat_int"), degrees("lon_int"))
    )
    leaves = leaves.selectExpr("level AS to_level", "row AS to_row", "col AS to_col", "x", "y", "lat_int", "lon_int")
    found = (
        running.join(small_side(leaves), place)
        .groupBy("lat", "lon")
        .agg(F.min(F.struct(F.round(distance, 3).alias("dist_m"), "x", "y")).alias("near"))
        .select("lat", "lon", "near.x", "near.y", "near.dist_m")
    )
    return points.join(found, ["lat", "lon"], "left").select(*points.columns, "x", "y", "dist_m")


def match_streets(
    located: DataFrame, cell_streets: DataFrame, street_names: DataFrame
) -> DataFrame:
    """Street elements of each point's cell, flagged where the point's text names the street.

    A point without element or name stays, with NULLs.
    """
    by_cell = cell_streets.select(
        F.col("stadt_x").alias("x"), F.col("stadt_y").alias("y"), "element_nr"
    )
    return (
        located.select("bez", "x", "y")
        .join(by_cell, ["x", "y"], "left")
        .join(street_names.select("element_nr", "strassenname"), "element_nr", "left")
        .select(
            "bez",
            "element_nr",
            "strassenname",
            contains_name("bez", "strassenname").alias("strname_match"),
        )
    )


def _spread(rows: DataFrame, side: DataFrame, on: str) -> DataFrame:
    """``rows`` dealt over as many tasks as their join with ``side`` needs by the rows it gives.

    A few stored rows would otherwise be one task, however many rows each of them leads to. Both
    tables are counted by ``on``, so they should be stored ones.
    """
    both = rows.groupBy(on).agg(F.count(F.lit(1)).alias("n")).join(side.groupBy(on).agg(F.count(F.lit(1)).alias("m")), on)
    given = both.agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0
    return rows.repartition(max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-given // ROWS_PER_TASK)))


def cells_of_streets(matches: DataFrame, cell_streets: DataFrame) -> DataFrame:
    """All cells of the matched street elements, one row per (match, cell).

    The matches, a few per point, are staged, because their number decides how they are spread.
    """
    cells = cell_streets.select(
        "element_nr", F.col("stadt_x").alias("x"), F.col("stadt_y").alias("y")
    )
    named = cut_lineage(matches.filter(F.col("strname_match")).select("element_nr", "bez"))
    return (
        _spread(named, cells, "element_nr")
        .join(small_side(cells), "element_nr", "left")
        .select("element_nr", "bez", "x", "y")
    )


def on_local_days(
    df: DataFrame, days: Sequence[date], ts: str = "date_time", tz: str = LOCAL_TZ
) -> DataFrame:
    """Rows whose local date is one of ``days``, as ranges of instants that reach the scan."""
    ranges = [TimeRange.half_open(d, d + timedelta(days=1), tz) for d in days]
    return df.filter(reduce(or_, [r.predicate(ts) for r in ranges], F.lit(False)))


def compare_at_points(
    points: DataFrame,
    cell_coords: DataFrame,
    cell_streets: DataFrame,
    street_names: DataFrame,
    vintages: Sequence[tuple[DataFrame, DataFrame]],
    value: str = "value",
) -> DataFrame:
    """Mean scaled prediction per time, street element and counting point.

    The mean is the same for every point that names an element, so it is taken once per time and
    element, over the cells of matched elements only, and handed to the points afterwards. The
    matches, a few per point, and the means are staged because they are used twice.
    """
    matches = match_streets(nearest_cell(points, cell_coords), cell_streets, street_names)
    named = matches.filter(F.col("strname_match")).select("element_nr", "bez").distinct()
    named = cut_lineage(named)
    cells = cell_streets.select(
        "element_nr", F.col("stadt_x").alias("x"), F.col("stadt_y").alias("y")
    ).join(named.select("element_nr").distinct(), "element_nr", "left_semi")
    per_element = (
        scaled_union(vintages, value)
        .join(small_side(cells), ["x", "y"])
        .groupBy("date_time", "element_nr")
        .agg(F.avg("pred").alias("pred"))
    )
    per_element = cut_lineage(per_element)
    handed = _spread(per_element, named, "element_nr").join(small_side(named), "element_nr")
    return handed.select("date_time", "element_nr", "bez", "pred")
