import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorgrid.operators import splits

START = datetime(2022, 1, 1)


@pytest.fixture(scope="module")
def weekly(spark):
    data = [(i, START + timedelta(weeks=i)) for i in range(101)]
    return spark.createDataFrame(data, "i int, date_time timestamp_ntz")


def test_temporal_split_keeps_the_cut_in_training(weekly):
    out = {r["i"]: r["split"] for r in splits.temporal_split(weekly).collect()}
    assert out[88] == "train" and out[89] == "test" and out[100] == "test"


def test_time_folds_grow_and_tile_the_end(weekly):
    out = splits.expanding_folds(weekly).orderBy("i").collect()
    for fold in range(1, 5):
        stop = 100 - 12 * (5 - fold)
        got = [r[f"fold_{fold}"] for r in out]
        assert got == ["train"] * (stop + 1) + ["test"] * 12 + ["unused"] * (100 - stop - 12)
    with pytest.raises(ValueError):
        splits.expanding_folds(weekly, mode="other")


def slices(n, block, k):
    """Stops from n − k·block on, every block + 1 rows, while a block still fits."""
    out, stop = [], n - k * block
    while stop + block <= n:
        out.append(stop)
        stop += block + 1
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_row_folds_match_numbered_rows(spark, hot):
    """With ``hot`` a third of all rows share one time and place."""
    rng = random.Random(5)
    data = []
    for i in range(900):
        at = START if hot and i % 3 == 0 else START + timedelta(hours=rng.randrange(60))
        place = (1, 1) if hot and i % 3 == 0 else (rng.randrange(3), rng.randrange(2))
        data.append((i, at, *place))
    df = spark.createDataFrame(data, "id int, date_time timestamp_ntz, x int, y int")
    block = 170
    out = splits.expanding_folds(df, mode="rows", tie=["id"], block_rows=block).toPandas()
    ordered = (
        df.withColumn("h", F.md5(F.col("id").cast("string"))).toPandas()
        .sort_values(["date_time", "x", "y", "h", "id"])["id"].tolist()
    )
    position = {row: p for p, row in enumerate(ordered, 1)}
    stops = slices(900, block, 4)
    assert len(stops) == 3 and [c for c in out.columns if c.startswith("fold_")] == ["fold_1", "fold_2", "fold_3"]
    for i, stop in enumerate(stops, 1):
        for row, label in zip(out["id"], out[f"fold_{i}"], strict=True):
            p = position[row]
            assert label == ("train" if p <= stop else "test" if p <= stop + block else "unused")


def test_row_folds_block_from_the_mean_number_of_sensors(spark):
    data = [(h * 2 + s, START + timedelta(hours=h), s, 0) for h in range(1000) for s in range(2)]
    df = spark.createDataFrame(data, "id int, date_time timestamp_ntz, x int, y int")
    out = splits.row_folds(df, tie=["id"], weeks=1)
    assert out.filter("fold_1 = 'test'").count() == 2 * 168
    assert out.filter("fold_1 = 'train'").count() == 2000 - 4 * 2 * 168


def test_too_short_data_has_no_row_folds(spark):
    df = spark.createDataFrame([(1, START, 0, 0)], "id int, date_time timestamp_ntz, x int, y int")
    row = splits.row_folds(df, tie=["id"], block_rows=10).first()
    assert [row[f"fold_{i}"] for i in (1, 2, 3)] == ["unused"] * 3


def test_group_folds_keep_sensors_together(spark):
    df = spark.range(5000).select((F.col("id") % 200).cast("string").alias("mq_name"))
    out = splits.group_folds(df, seed=3)
    assert out.select("mq_name", "fold").distinct().count() == 200
    assert {r[0] for r in out.select("fold").distinct().collect()} == {1, 2, 3, 4, 5}
    other = splits.group_folds(df, seed=4)
    assert not out.exceptAll(other).isEmpty()
