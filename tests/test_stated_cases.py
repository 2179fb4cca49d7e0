"""The cases stated for the three helper functions: sensors per hour, prepared rows, chunks."""

import math
from datetime import datetime

import pytest

from sensorgrid.operators.scoring import chunk_keys, prepare_predictions
from sensorgrid.operators.splits import avg_sensors_per_hour

SEEN = [
    (datetime(2020, 1, 1, 1), 1.0, 1.0),
    (datetime(2020, 1, 1, 2), 1.0, 1.0),
    (datetime(2020, 1, 1, 3), 1.0, 1.0),
    (datetime(2020, 1, 1, 2), 2.0, 5.0),
    (datetime(2020, 1, 1, 3), 2.0, 5.0),
    (datetime(2020, 1, 1, 3), 3.0, 5.0),
]


@pytest.mark.parametrize("part, expected", [(SEEN, 2.0), (SEEN[:3], 1.0), (SEEN[3:], 1.5)])
def test_mean_number_of_sensors_per_hour(spark, part, expected):
    df = spark.createDataFrame(part, "date_time timestamp_ntz, x double, y double")
    assert avg_sensors_per_hour(df).first()["avg_sensors"] == expected


def test_places_with_a_missing_coordinate_count(spark):
    seen = [(datetime(2020, 1, 1), 1.0, None), (datetime(2020, 1, 1), 1.0, 2.0)]
    df = spark.createDataFrame(seen, "date_time timestamp_ntz, x double, y double")
    assert avg_sensors_per_hour(df).first()["avg_sensors"] == 2.0


@pytest.mark.parametrize("model_id", [99, None])
def test_prepared_predictions(spark, model_id):
    days = [(datetime(2022, 1, 2), 1.0, 3.0, 17.0), (datetime(2022, 1, 3), 2.0, 4.0, 18.0)]
    df = spark.createDataFrame(days, "date_time timestamp_ntz, x double, y double, value double")
    out = prepare_predictions(df.select("y", "value", "x", "date_time"), model_id)
    lead = [] if model_id is None else ["model_id"]
    assert out.columns == [*lead, "date_time", "x", "y", "value"]
    expected = [d if model_id is None else (model_id, *d) for d in days]
    assert sorted(map(tuple, out.collect())) == expected


@pytest.mark.parametrize(
    "values, length, expected",
    [
        ([3, 6, 5, 7, 7], 2, {1: "3, 6", 2: "5, 7", 3: "7"}),
        ([2, 1], 3, {1: "2, 1"}),
        ([2, 1, 99, 2], math.inf, {0: "2, 1, 99, 2"}),
    ],
)
def test_chunks_keep_order_and_duplicates(spark, values, length, expected):
    df = spark.createDataFrame(list(enumerate(values)), "place int, v int")
    got = chunk_keys(df, "v", length, order_by="place").collect()
    assert {r["chunk"]: r["keys"] for r in got} == expected
