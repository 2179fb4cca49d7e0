"""The library's input tables, derived from the given star-schema tables.

Every view reads its source tables whole. Streets, buildings and street elements lie one cell off
the grid's own, so that some cells lack a row and some rows lack a cell. The same definitions stand as SQL in ``oracles.py``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.schemas import BUILDING_COLUMNS, LAND_USE_COLUMNS, STREET_COLUMNS, VOLUME_COLUMNS



class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def obs(self) -> DataFrame:
        """Events as hourly observations: errors carry no count, sign-ups no speed."""
        return self.table("events").select(
            "event_id",
            F.concat(F.lit("det_"), F.col("user_id").cast("string")).alias("mq_name"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_time"),
            F.when(F.col("event_type") == "error", -1.0).otherwise(F.col("value")).alias("q_kfz"),
            F.when(F.col("event_type") == "signup", -1.0)
            .otherwise((20 + F.col("event_id") % 60).cast("double"))
            .alias("v_kfz"),
            (F.col("user_id") % 15).cast("bigint").alias("x"),
            F.floor(F.col("user_id") / 15.0).cast("bigint").alias("y"),
        )

    @cached_property
    def cells(self) -> DataFrame:
        return self.table("supplier").select(
            (F.col("s_suppkey") % 10).cast("bigint").alias("x"),
            F.floor(F.col("s_suppkey") / 10.0).cast("bigint").alias("y"),
            "s_suppkey",
            "s_nationkey",
            "s_acctbal",
        )

    @cached_property
    def sensor_map(self) -> DataFrame:
        return (
            self.obs.select("x", "y")
            .distinct()
            .select(
                F.col("x").alias("det_x"),
                F.col("y").alias("det_y"),
                (F.col("x") % 10).cast("bigint").alias("stadt_x"),
                (F.col("y") % 10).cast("bigint").alias("stadt_y"),
            )
        )

    @cached_property
    def stations(self) -> DataFrame:
        """Parts as stations, in cells that may lie outside the grid."""
        return (
            self.table("part")
            .select(
                (F.col("p_size") % 12).cast("bigint").alias("stadt_x"),
                F.length("p_name").cast("bigint").alias("stadt_y"),
            )
            .distinct()
        )

    @cached_property
    def streets(self) -> DataFrame:
        """One column to the right of the cells."""
        lengths = [
            (F.col("s_suppkey") % (k + 2)).cast("bigint").alias(name)
            for k, name in enumerate(STREET_COLUMNS)
        ]
        return self.cells.select((F.col("x") + 1).alias("x"), "y", *lengths)

    @cached_property
    def land_use(self) -> DataFrame:
        shares = [
            ((F.col("s_suppkey") % (k + 4)).cast("double") / (k + 4)).alias(name)
            for k, name in enumerate(LAND_USE_COLUMNS)
        ]
        return self.cells.select("x", "y", *shares)

    @cached_property
    def buildings(self) -> DataFrame:
        """One row above the cells."""
        return self.cells.select(
            "x",
            (F.col("y") + 1).alias("y"),
            ((F.col("s_suppkey") % 5).cast("double") / 5).alias("density"),
            (3 + F.col("s_suppkey") % 20).cast("double").alias("height"),
        )

    @cached_property
    def volume(self) -> DataFrame:
        return self.cells.select(
            "x",
            "y",
            F.when(F.col("s_nationkey") < 3, 0.0)
            .when(F.col("s_nationkey") < 6, 20000.0)
            .otherwise(F.abs("s_acctbal") / 5)
            .alias("kfz_per_24h"),
        )

    @property
    def sides(self):
        return [
            (self.streets, STREET_COLUMNS),
            (self.land_use, LAND_USE_COLUMNS),
            (self.volume, VOLUME_COLUMNS),
            (self.buildings, BUILDING_COLUMNS),
        ]

    @cached_property
    def calendar(self) -> DataFrame:
        hours = self.obs.select("date_time").distinct()
        day = F.dayofmonth("date_time")
        return hours.select(
            "date_time",
            F.when(day.between(3, 6), "Winterferien")
            .when(day.between(20, 25), "Sommerferien")
            .alias("type_school_holiday"),
            F.when(day == 1, 1).otherwise(0).alias("is_public_holiday"),
            (F.dayofyear("date_time").cast("double") / 366).alias("doy_scaled"),
        )

    @cached_property
    def preds_year(self) -> DataFrame:
        """Line items as predictions of two models for supplier cells."""
        return self.table("lineitem").select(
            (1 + F.col("l_linenumber") % 2).cast("bigint").alias("model_id"),
            F.col("l_shipdate").alias("date_time"),
            (F.col("l_suppkey") % 10).cast("bigint").alias("x"),
            F.floor(F.col("l_suppkey") / 10.0).cast("bigint").alias("y"),
            F.when(F.col("l_suppkey") % 11 == 0, 0.0).otherwise(F.col("l_quantity")).alias("value"),
        )

    @cached_property
    def points(self) -> DataFrame:
        """Customers as counting points; their text names a nation. A few have no latitude."""
        c, n = self.table("customer"), self.table("nation")
        key = F.col("c_custkey")
        row = (key * 37 % 1009).cast("double")
        return c.join(n, c.c_nationkey == n.n_nationkey).select(
            F.concat_ws(" ", "c_name", "n_name").alias("bez"),
            F.when(row != 5, 52.3 + row / 2500.0).alias("lat"),
            (13.1 + (key * 53 % 997).cast("double") / 2000.0).alias("lon"),
        )

    @cached_property
    def cell_coords(self) -> DataFrame:
        return self.cells.select(
            "x",
            "y",
            (5_230_000 + F.col("y") * 4000).cast("bigint").alias("lat_int"),
            (1_310_000 + F.col("x") * 5000).cast("bigint").alias("lon_int"),
        )

    @cached_property
    def cell_streets(self) -> DataFrame:
        """One column to the right of the cells."""
        return self.cells.select(
            (F.col("x") + 1).alias("stadt_x"),
            F.col("y").alias("stadt_y"),
            F.concat(F.lit("el_"), (F.col("s_suppkey") % 28).cast("string")).alias("element_nr"),
        )

    @cached_property
    def street_names(self) -> DataFrame:
        """Street elements named after nations; elements 25 to 27 have no name."""
        return self.table("nation").select(
            F.concat(F.lit("el_"), F.col("n_nationkey").cast("string")).alias("element_nr"),
            F.col("n_name").alias("strassenname"),
        )
