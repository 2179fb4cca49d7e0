from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorgrid.functions.timeparts import TimeRange
from sensorgrid.operators import features as ft
from sensorgrid.schemas import BUILDING_COLUMNS, LAND_USE_COLUMNS, SCHEMAS, STREET_COLUMNS, VOLUME_COLUMNS

START = datetime(2023, 1, 1)


@pytest.fixture(scope="module")
def domain(spark):
    """A 3 × 3 grid with holes in the street and building tables."""
    cells = [(x, y) for x in range(3) for y in range(3)]

    def make(name, data):
        return spark.createDataFrame(data, SCHEMAS[name])

    return {
        "cells": make("cells", cells),
        "streets": make("streets", [(x, y, *[float(k + x) for k in range(6)]) for x, y in cells if x]),
        "land_use": make("land_use", [(x, y, *[0.1 * k for k in range(7)]) for x, y in cells]),
        "buildings": make("buildings", [(x, y, 0.5, 10.0 + y) for x, y in cells if y]),
        "traffic_volume": make("traffic_volume", [(x, y, 100.0 * x + y) for x, y in cells]),
        "sensor_map": make("sensor_map", [(10, 20, 0, 0), (11, 21, 2, 1), (12, 22, 9, 9)]),
        "location_map": make("location_map", [(1, 1), (7, 7)]),
        "calendar": make(
            "calendar",
            [
                (START + timedelta(hours=h), "Sommerferien" if h < 5 else None, int(h < 2), h / 100)
                for h in range(48)
            ],
        ),
        "observations": make(
            "observations",
            [
                ("a", START, 5.0, -1.0, 10, 20),
                ("a", START + timedelta(hours=1), -1.0, 30.0, 10, 20),
                ("b", START + timedelta(hours=3), 7.0, None, 11, 21),
                ("c", START + timedelta(hours=4), None, 40.0, 12, 22),
                ("d", START + timedelta(days=9), 9.0, 50.0, 99, 99),
            ],
        ),
    }


@pytest.fixture(scope="module")
def sides(domain):
    return [
        (domain["streets"], STREET_COLUMNS),
        (domain["land_use"], LAND_USE_COLUMNS),
        (domain["traffic_volume"], VOLUME_COLUMNS),
        (domain["buildings"], BUILDING_COLUMNS),
    ]


def test_training_frame_on_domain_tables(domain, sides):
    out = ft.training_frame(domain["observations"], domain["calendar"], domain["sensor_map"], sides)
    got = {(r["mq_name"], r["date_time"]): r for r in out.collect()}
    assert len(got) == 5
    first = got["a", START]
    assert (first["q_kfz"], first["summer_holidays"], first["is_public_holiday"]) == (5.0, True, 1)
    assert (first["str_class_0"], first["land_living"], first["building_height"]) == (0.0, pytest.approx(0.6), 0.0)
    b = got["b", START + timedelta(hours=3)]
    assert (b["str_class_V"], b["traffic_volume"], b["building_height"]) == (7.0, 201.0, 11.0)
    d = got["d", START + timedelta(days=9)]
    assert (d["summer_holidays"], d["day_of_year"], d["traffic_volume"], d["hour"]) == (False, 0.0, 0.0, 1)


def test_unmatched_cells_as_null(domain, sides):
    out = ft.training_frame(
        domain["observations"], domain["calendar"], domain["sensor_map"], sides, unmatched="null", sort=True
    )
    d = out.collect()[-1]
    assert d["traffic_volume"] is None and d["day_of_year"] is None
    with pytest.raises(ValueError):
        ft.cell_features(domain["cells"], sides, unmatched="drop")


@pytest.mark.parametrize("kind", ["grid", "sensors", "stations"])
def test_feature_frame_is_locations_by_hours(domain, sides, kind):
    locations = {
        "grid": ft.grid_locations(domain["cells"]),
        "sensors": ft.sensor_locations(domain["cells"], domain["sensor_map"]),
        "stations": ft.mapped_locations(domain["location_map"]),
    }[kind]
    span = TimeRange.half_open("2023-01-01 06:00", "2023-01-02 09:00", "UTC")
    out = ft.feature_frame(locations, domain["calendar"], sides, span)
    n = {"grid": 9, "sensors": 2, "stations": 2}[kind]
    assert out.count() == n * 27
    assert out.select("x", "y", "date_time").distinct().count() == n * 27
    assert out.agg(F.min("date_time"), F.max("date_time")).first() == (
        datetime(2023, 1, 1, 6), datetime(2023, 1, 2, 8),
    )


def test_product_equals_a_plain_cross_join(spark, domain):
    """Also with repeated, irregular and missing hours."""
    times = [START, START, START + timedelta(minutes=17), START + timedelta(days=40, hours=23)]
    hours = spark.createDataFrame([(t, i) for i, t in enumerate(times)], "date_time timestamp_ntz, i int")
    cells = domain["cells"]
    got = ft.locations_by_hours(cells, hours)
    expected = cells.crossJoin(hours)
    assert got.exceptAll(expected.select(got.columns)).isEmpty()
    assert got.count() == expected.count() == 36
    assert ft.locations_by_hours(cells, hours.limit(0)).count() == 0


def test_hours_beyond_the_broadcast_bound_are_merge_joined(spark, domain, monkeypatch):
    monkeypatch.setattr(ft, "small_side", lambda df, rows: df)
    hours = domain["calendar"].select("date_time")
    assert ft.locations_by_hours(domain["cells"], hours).count() == 9 * 48


def test_chunks_together_equal_the_whole_frame(domain, sides):
    locations = ft.grid_locations(domain["cells"])
    whole = ft.feature_frame(locations, domain["calendar"], sides)
    parts = [ft.feature_frame(locations, domain["calendar"], sides, x_coords=xs) for xs in ([0, 2], [1])]
    both = parts[0].unionByName(parts[1])
    assert both.count() == whole.count()
    assert both.exceptAll(whole).isEmpty()


def test_mixed_sort_order(domain, sides):
    out = ft.feature_frame(ft.grid_locations(domain["cells"]), domain["calendar"], sides, sort=True)
    got = [(r["x"], r["y"], r["date_time"]) for r in out.collect()]
    assert got == sorted(got, key=lambda r: (r[0], r[1], -r[2].timestamp()))


def test_incremental_scan(spark, domain):
    target = spark.createDataFrame(
        [(1, START + timedelta(hours=10)), (2, START + timedelta(hours=30))],
        "model_id int, date_time timestamp_ntz",
    )
    calendar = domain["calendar"]
    assert ft.incremental_scan(calendar, target).count() == 17
    assert ft.incremental_scan(calendar, target, key={"model_id": 1}).count() == 37
    assert ft.incremental_scan(calendar, target, key={"model_id": 3}).count() == 48
    upper = TimeRange(end=START + timedelta(hours=40))
    assert ft.incremental_scan(calendar, target, upper=upper).count() == 10


def test_sentinel_and_null_targets_go(domain):
    assert ft.drop_sentinel(domain["observations"], "q_kfz_mq_hr").count() == 3


@pytest.mark.parametrize("n, expected", [(0, 0), (1, 1), (137, 137), (2000, 2000), (5000, 2000)])
def test_sample_size_is_exact(spark, n, expected):
    df = spark.range(2000)
    out = ft.sample_n(df, n, ["id"], seed=4)
    ids = [r[0] for r in out.collect()]
    assert len(ids) == len(set(ids)) == expected


def test_samples_are_nested_and_repeatable(spark):
    df = spark.range(2000)
    small = {r[0] for r in ft.sample_n(df, 50, ["id"]).collect()}
    large = {r[0] for r in ft.sample_n(df.repartition(13), 500, ["id"]).collect()}
    assert small < large
    assert ft.sample_fraction(df, 0.1005, ["id"]).count() == 201
    assert ft.hash_sample(df, 1.0, ["id"]).count() == 2000


def test_training_data_from_a_snapshot(spark, domain, sides, tmp_path):
    frame = ft.training_frame(domain["observations"], domain["calendar"], domain["sensor_map"], sides)
    stored = ft.snapshot(frame, str(tmp_path / "frame"))
    assert stored.dtypes == frame.dtypes
    out = ft.training_data(spark, str(tmp_path / "frame"), "q_kfz", sort=True)
    assert [r["mq_name"] for r in out.collect()] == ["a", "b", "d"]
    assert ft.training_data(spark, stored, "q_kfz", dev=True, fraction=0.7).count() == 2
