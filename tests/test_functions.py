from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sensorgrid.functions import expressions as ex
from sensorgrid.functions import timeparts as tp


def one(df):
    return [r[0] for r in df.collect()]


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Europe/Berlin"])
def test_local_parts_do_not_depend_on_the_session_zone(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        cases = [
            ("2018-12-31 23:00:00", (2, 2019, 0, True)),
            ("2023-01-01 00:00:00", (7, 2023, 1, True)),
            ("2023-01-02 00:00:00", (1, 2023, 1, True)),
            ("2023-07-01 00:00:00", (6, 2023, 2, False)),
            ("2023-03-26 00:59:00", (7, 2023, 1, True)),
            ("2023-03-26 01:00:00", (7, 2023, 3, False)),
            ("2023-10-29 00:59:00", (7, 2023, 2, False)),
            ("2023-10-29 01:00:00", (7, 2023, 2, True)),
        ]
        df = spark.createDataFrame([(c[0],) for c in cases], "t string")
        df = df.select("t", F.to_timestamp_ntz("t").alias("date_time"))
        got = {r["t"]: tuple(r)[2:] for r in tp.time_parts(df).collect()}
        assert got == dict(cases)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_holiday_flags(spark):
    df = spark.createDataFrame([(None,), ("Sommerferien",), ("Winterferien",)], "kind string")
    got = df.select(tp.summer_holidays("kind"), tp.other_school_holidays("kind")).collect()
    assert [tuple(r) for r in got] == [(False, False), (True, False), (False, True)]


def test_format_timestamp(spark):
    df = spark.sql("SELECT timestamp_ntz'2022-07-29 01:00:00' AS t")
    assert one(df.select(tp.format_timestamp("t"))) == ["2022-07-29 01:00:00"]


def test_utc_instant_is_the_inverse_of_local_time(spark):
    df = spark.sql("SELECT timestamp_ntz'2022-07-29 01:00:00' AS t")
    assert one(df.select(tp.utc_instant(tp.local_time("t")))) == [datetime(2022, 7, 29, 1)]


def test_time_ranges():
    as_of = datetime(2023, 3, 20, 10, 30)  # 11:30 in Berlin; summer time starts on 26 March
    year = tp.TimeRange.local_year(2019)
    assert (year.start, year.end) == (datetime(2018, 12, 31, 23), datetime(2019, 12, 31, 23))
    assert year.hours() == 365 * 24
    around = tp.TimeRange.around_today(as_of)
    assert (around.start, around.end) == (datetime(2023, 3, 18, 23), datetime(2023, 7, 9, 22))
    assert around.hours() == 24 * 113 + 1 - 1  # an hour less across the change of the clock
    winter = tp.TimeRange.around_today(datetime(2022, 11, 2, 12))
    assert winter.hours() == 24 * 113 + 1
    since = tp.TimeRange.since("2015-01-01", as_of)
    assert (since.start, since.end) == (datetime(2014, 12, 31, 23), datetime(2023, 7, 10, 9, 30))
    until = tp.TimeRange.until(as_of)
    assert (until.start, until.end) == (None, datetime(2023, 6, 11, 22))
    closed = tp.TimeRange.closed("2021-11-01 00:00:00", "2022-10-31 23:59:59")
    assert (closed.start, closed.end) == (datetime(2021, 10, 31, 23), datetime(2022, 10, 31, 22, 59, 59))
    assert tp.TimeRange.half_open(date(2022, 1, 1), date(2022, 1, 2)).hours() == 24


def test_time_range_bounds(spark):
    hours = "sequence(timestamp_ntz'2023-01-01 00:00:00', timestamp_ntz'2023-01-03 00:00:00', interval 1 hour)"
    df = spark.sql(f"SELECT explode({hours}) AS date_time")
    day = tp.TimeRange.half_open("2023-01-01", "2023-01-02", tz="UTC")
    assert df.filter(day.predicate()).count() == 24 == day.hours()
    both = tp.TimeRange.closed("2023-01-01", "2023-01-02", tz="UTC")
    assert df.filter(both.predicate()).count() == 25 == both.hours()
    assert df.filter(tp.TimeRange().predicate()).count() == 49


@pytest.mark.parametrize(
    "volume, predicted, expected",
    [
        (10.0, 0.0, 5.0),
        (0.0, 0.0, 0.0),
        (0.0005, 0.00005, 5.0),
        (0.0005, 10.0, 0.0),
        (1.0, 100.0, 0.1),
        (50.0, 25.0, 2.0),
        (100.0, 10.0, 5.0),
        (None, 10.0, None),
    ],
)
def test_scaling_factor(spark, volume, predicted, expected):
    df = spark.createDataFrame([(volume, predicted)], "v double, p double")
    assert one(df.select(ex.scaling_factor("v", "p"))) == [expected]


def test_half_even_rounding_and_lower_bound(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-3.0,), (None,)], "v double")
    assert one(df.select(ex.round_half_even("v"))) == [0.0, 2.0, 2.0, -3.0, None]
    assert one(df.select(ex.non_negative("v"))) == [0.5, 1.5, 2.5, 0.0, None]


def test_contains_name(spark):
    df = spark.createDataFrame([("abc", ""), ("abc", "b"), ("abc", None)], "t string, n string")
    assert one(df.select(ex.contains_name("t", "n"))) == [False, True, None]


def test_feature_groups(spark):
    names = ["land_water", "str_class_I", "building_height", "is_public_holiday",
             "summer_holidays", "x", "y", "hour"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert one(df.select(ex.feature_group("f"))) == [
        "land_use", "street_class", "buildings", "holidays", "holidays",
        "coordinates", "coordinates", "hour",
    ]


def test_distance_in_metres(spark):
    df = spark.createDataFrame([(52.52, 13.405, 48.137, 11.575)], "a double, b double, c double, d double")
    distance = ex.metres(ex.haversine(*[F.col(c) for c in "abcd"]))
    assert one(df.select(distance))[0] == pytest.approx(504_300, rel=0.001)


def test_md5_buckets_are_even_and_repeatable(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    counts = df.groupBy(ex.md5_bucket(["k"], 7, 5).alias("b")).count().collect()
    assert {r["b"] for r in counts} == {1, 2, 3, 4, 5}
    assert all(abs(r["count"] - 4000) < 300 for r in counts)
    fraction = df.select(ex.md5_fraction(["k"], 7).alias("u"))
    assert fraction.filter("u < 0 OR u >= 1").isEmpty()
