import math
import random
from datetime import date

import pytest

from sensorgrid.operators import spatial
from sensorgrid.plans import manual_counts

RADIUS = 6_371_008.8


def distance(lat1, lon1, lat2, lon2):
    a, b, c, d = map(math.radians, (lat1, lon1, lat2, lon2))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * RADIUS * math.asin(math.sqrt(min(1.0, h)))


def nearest(points, cells):
    return {
        (bez, lat, lon): min(
            (round(distance(lat, lon, la / 1e5, lo / 1e5), 3), x, y) for x, y, la, lo in cells
        )
        for bez, lat, lon in points
    }


def city(rng):
    cells = [(x, y, 5_240_000 + 45 * y, 1_320_000 + 74 * x) for x in range(40) for y in range(30)]
    return cells, [(f"p{i}", 52.40 + rng.random() * 0.02, 13.20 + rng.random() * 0.03) for i in range(60)]


def globe(rng):
    cells = [(i, -i, rng.randint(-9_000_000, 9_000_000), rng.randint(-18_000_000, 18_000_000)) for i in range(400)]
    cells += [(1000, 0, 0, 17_999_000), (1001, 0, 0, -17_999_500), (1002, 0, 8_999_900, 0)]
    points = [(f"p{i}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(80)]
    edges = [("e1", 0.0, 180.0), ("e2", 0.0, -180.0), ("n", 90.0, 77.0), ("s", -90.0, 0.0), ("z", 0.0, 0.0)]
    return cells, points + edges


def far_and_hot(rng):
    """Points far off the grid, and a third of all points at one place."""
    cells, points = city(rng)
    return cells, points[:20] + [("far", -33.9, 151.2), ("pole", 89.9, 0.0)] + [
        (f"hot{i}", 52.41, 13.21) for i in range(11)
    ]


def ties(rng):
    cells = [(x, y, 100 * y, 100 * x) for x in (-1, 1) for y in (-1, 1)]
    return cells, [("middle", 0.0, 0.0), ("left", 0.0, -0.001)]


@pytest.mark.parametrize("layout", [city, globe, far_and_hot, ties])
def test_nearest_cell_matches_brute_force(spark, layout):
    cells, points = layout(random.Random(3))
    got = spatial.nearest_cell(
        spark.createDataFrame(points, "bez string, lat double, lon double"),
        spark.createDataFrame(cells, "x bigint, y bigint, lat_int bigint, lon_int bigint"),
    ).collect()
    assert len(got) == len(points)
    expected = nearest(points, cells)
    for r in got:
        dist, x, y = expected[r["bez"], r["lat"], r["lon"]]
        assert (r["x"], r["y"]) == (x, y), r
        assert r["dist_m"] == pytest.approx(dist, abs=0.002)


def test_points_without_a_nearest_cell_stay(spark):
    cells = spark.createDataFrame([(1, 2, 5_250_000, 1_340_000)], "x bigint, y bigint, lat_int bigint, lon_int bigint")
    points = [("a", None, 13.4), ("b", 52.5, None), ("c", 52.5, 13.4), ("c", 52.5, 13.4)]
    points = spark.createDataFrame(points, "bez string, lat double, lon double")
    got = sorted((r["bez"], r["x"], r["dist_m"]) for r in spatial.nearest_cell(points, cells).collect())
    assert got == [("a", None, None), ("b", None, None), ("c", 1, 0.0), ("c", 1, 0.0)]
    none = spatial.nearest_cell(points, cells.limit(0))
    assert none.count() == 4 and none.filter("x IS NOT NULL").isEmpty()


def test_each_level_of_the_search_takes_up_the_one_before_once(spark):
    """Also with more cells at one place than a tile may have, of which only the smallest can be nearest."""
    cells = [(i, 0, 5_250_000 + i % 7, 1_340_000) for i in range(50)] + [(99, 0, 5_950_000, 1_340_000)]
    points = [("a", 52.500021, 13.4), ("b", 59.4, 13.4)]
    found = spatial.nearest_cell(
        spark.createDataFrame(points, "bez string, lat double, lon double"),
        spark.createDataFrame(cells, "x bigint, y bigint, lat_int bigint, lon_int bigint"),
        tile_cells=2,
    )
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 12 + 2  # levels, leaves, points
    assert {r["bez"]: r["x"] for r in found.collect()} == {"a": 2, "b": 99}


@pytest.fixture(scope="module")
def streets(spark):
    cell_streets = spark.createDataFrame(
        [(0, 0, "e1"), (0, 1, "e1"), (0, 0, "e2"), (5, 5, "e3")],
        "stadt_x bigint, stadt_y bigint, element_nr string",
    )
    names = spark.createDataFrame(
        [("e1", "Ringstraße"), ("e2", ""), ("e3", "Ring")], "element_nr string, strassenname string"
    )
    return cell_streets, names


def test_street_matching(spark, streets):
    located = spark.createDataFrame(
        [("Ringstraße (Brücke)", 0, 0), ("nowhere", 9, 9)], "bez string, x bigint, y bigint"
    )
    matches = spatial.match_streets(located, *streets)
    got = {(r["bez"], r["element_nr"]): r["strname_match"] for r in matches.collect()}
    assert got == {
        ("Ringstraße (Brücke)", "e1"): True,
        ("Ringstraße (Brücke)", "e2"): False,
        ("nowhere", None): None,
    }
    cells = spatial.cells_of_streets(matches, streets[0]).collect()
    assert {(r["element_nr"], r["x"], r["y"]) for r in cells} == {("e1", 0, 0), ("e1", 0, 1)}


def test_few_matches_of_many_cells_are_spread(spark, streets, monkeypatch):
    """A handful of stored matches would be one task, however many cells each of them has."""
    monkeypatch.setattr(spatial, "ROWS_PER_TASK", 2, raising=False)
    matches = spark.createDataFrame(
        [("e1", f"p{i}", True) for i in range(30)], "element_nr string, bez string, strname_match boolean"
    )
    out = spatial.cells_of_streets(matches, streets[0])
    assert "Repartition 30, true" in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 60


def test_comparison_at_points(spark, streets):
    """Two points name one element; a cell listed twice for an element counts twice."""
    cell_streets, names = streets
    cell_streets = cell_streets.unionByName(cell_streets.filter("element_nr = 'e1' AND stadt_y = 1"))
    coords = spark.createDataFrame(
        [(0, 0, 5_250_000, 1_340_000), (0, 1, 5_250_100, 1_340_000), (5, 5, 5_251_000, 1_341_000)],
        "x bigint, y bigint, lat_int bigint, lon_int bigint",
    )
    points = spark.createDataFrame(
        [("Ringstraße west", 52.5, 13.4), ("Ringstraße ost", 52.5001, 13.4), ("Allee", 52.51, 13.41)],
        "bez string, lat double, lon double",
    )
    predictions = spark.sql(
        "SELECT timestamp_ntz'2023-05-04 10:00:00' AS date_time, x, y, v AS value FROM VALUES "
        "(0L, 0L, 10D), (0L, 1L, 40D), (5L, 5L, 7D) AS t(x, y, v)"
    )
    factors = spark.createDataFrame(
        [(0, 0, 2.0), (0, 1, 1.0), (5, 5, 1.0)], "x bigint, y bigint, scaling double"
    )
    out = spatial.compare_at_points(points, coords, cell_streets, names, [(predictions, factors)])
    mean = (10 * 2 + 40 + 40) / 3
    assert {(r["element_nr"], r["bez"]): r["pred"] for r in out.collect()} == {
        ("e1", "Ringstraße west"): pytest.approx(mean),
        ("e1", "Ringstraße ost"): pytest.approx(mean),
    }
    day = predictions.select("date_time").distinct()
    assert spatial.on_local_days(day, [date(2023, 5, 4)]).count() == 1
    assert spatial.on_local_days(day, [date(2023, 5, 5)]).count() == 0


def test_predictions_at_manual_counts(spark):
    points = manual_counts.counting_points(spark)
    assert points.count() == 26 == points.select("bez").distinct().count()
    cells = [(i, 0, round(lat * 1e5), round(lon * 1e5)) for i, (lat, lon, _) in enumerate(manual_counts.COUNTING_POINTS)]
    coords = spark.createDataFrame(cells, "x bigint, y bigint, lat_int bigint, lon_int bigint")
    streets = spark.createDataFrame(
        [(11, 0, "ring"), (16, 0, "daum"), (99, 0, "ring")], "stadt_x bigint, stadt_y bigint, element_nr string"
    )
    names = spark.createDataFrame(
        [("ring", "Ringstraße"), ("daum", "Daumstraße")], "element_nr string, strassenname string"
    )
    hour = "SELECT {} AS model_id, timestamp_ntz'{}' AS date_time, x, 0L AS y, 8D AS value FROM VALUES (11L), (16L), (99L) AS t(x)"
    # 22:30 UTC is already the next day in summer
    earlier = spark.sql(hour.format(1, "2022-05-30 22:30:00") + " UNION ALL " + hour.format(1, "2022-05-31 22:30:00"))
    later = spark.sql(hour.format(21, "2023-05-04 10:00:00") + " UNION ALL " + hour.format(20, "2023-06-28 10:00:00"))
    factors = spark.createDataFrame([(11, 0, 1.0), (16, 0, 0.5), (99, 0, 3.0)], "x bigint, y bigint, scaling double")
    out = manual_counts.predictions_at_counts(coords, streets, names, (earlier, factors), (later, factors))
    got = {(str(r["date_time"]), r["element_nr"]): r["pred"] for r in out.collect()}
    assert got == {
        ("2022-05-30 22:30:00", "ring"): 16.0, ("2022-05-30 22:30:00", "daum"): 4.0,
        ("2023-05-04 10:00:00", "ring"): 16.0, ("2023-05-04 10:00:00", "daum"): 4.0,
    }
