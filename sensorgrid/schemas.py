"""Table schemas and column checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

# --- Fixed values: column names of the source tables and their names in the model -------------
STREET_COLUMNS = {
    "strassenklasse_0": "str_class_0",
    "strassenklasse_I": "str_class_I",
    "strassenklasse_II": "str_class_II",
    "strassenklasse_III": "str_class_III",
    "strassenklasse_IV": "str_class_IV",
    "strassenklasse_V": "str_class_V",
}
LAND_USE_COLUMNS = {
    "gewaesser": "land_water",
    "grauflaeche": "land_grey",
    "gruenflaeche": "land_green",
    "infrastruktur": "land_infra",
    "mischnutzung": "land_mixed",
    "wald": "land_forest",
    "wohnnutzung": "land_living",
}
BUILDING_COLUMNS = {"density": "building_density", "height": "building_height"}
VOLUME_COLUMNS = {"kfz_per_24h": "traffic_volume"}
# ----------------------------------------------------------------------------------------------




def _doubles(names: Iterable[str]) -> str:
    return ", ".join(f"{n} double" for n in names)


# Times are UTC instants without a zone; the local zone is an argument wherever it matters.
SCHEMAS: dict[str, str] = {
    "observations": "mq_name string, date_time timestamp_ntz, q_kfz_mq_hr double, "
    "v_kfz_mq_hr double, x bigint, y bigint",
    "calendar": "date_time timestamp_ntz, type_school_holiday string, is_public_holiday int, "
    "doy_scaled double",
    "cells": "x bigint, y bigint",
    "sensor_map": "det_x bigint, det_y bigint, stadt_x bigint, stadt_y bigint",
    "location_map": "stadt_x bigint, stadt_y bigint",
    "cell_coords": "x bigint, y bigint, lon_int bigint, lat_int bigint",
    "cell_streets": "stadt_x bigint, stadt_y bigint, element_nr string",
    "street_names": "element_nr string, strassenname string",
    "streets": "x bigint, y bigint, " + _doubles(STREET_COLUMNS),
    "land_use": "x bigint, y bigint, " + _doubles(LAND_USE_COLUMNS),
    "buildings": "x bigint, y bigint, " + _doubles(BUILDING_COLUMNS),
    "traffic_volume": "x bigint, y bigint, " + _doubles(VOLUME_COLUMNS),
    "cross_sections": "lat_int bigint, lon_int bigint",
    "reprojection": "lat_int bigint, lon_int bigint, x bigint, y bigint",
    "predictions": "model_id bigint, date_time timestamp_ntz, x bigint, y bigint, value double",
    "scaling": "x bigint, y bigint, kfz_per_24h double, kfz_per_24h_pred double, scaling double",
    "model_description": "model_id bigint, date_time timestamp_ntz, model_name string, "
    "depvar string, description string",
    "final_models": "depvar string, model_id bigint",
    "points": "lat double, lon double, bez string",
}


def require_columns(df: DataFrame, columns: Iterable[str], where: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{where}: missing columns {missing}; found {df.columns}")
