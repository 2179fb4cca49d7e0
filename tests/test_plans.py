"""The two runs end to end on a small domain, and the broken-off backfill."""

import math
import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorgrid.driver.models import fixed_model
from sensorgrid.functions.timeparts import TimeRange
from sensorgrid.operators import features as ft
from sensorgrid.operators import boosting, scoring
from sensorgrid.operators.boosting import predict
from sensorgrid.operators.model import BoostParams, FeatureSpec, random_grid
from sensorgrid.plans import calibration, explanation, validation
from sensorgrid.schemas import SCHEMAS, VOLUME_COLUMNS
from sensorgrid.sources.tables import Table

NOW = datetime(2019, 2, 1, 12)
FEATURES = ("x", "y", "hour", "day_of_week", "traffic_volume")


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    cells = [(x, y) for x in range(3) for y in range(2)]
    start = datetime(2018, 12, 31, 23)

    def make(name, data):
        path = str(tmp_path_factory.mktemp(name))
        spark.createDataFrame(data, SCHEMAS[name]).coalesce(1).write.mode("overwrite").parquet(path)
        return spark.read.schema(SCHEMAS[name]).parquet(path)

    volume = make("traffic_volume", [(x, y, 100.0 * (x + 1)) for x, y in cells])
    return calibration.Inputs(
        calendar=make("calendar", [(start + timedelta(hours=h), None, 0, h / 8784) for h in range(60 * 24)]),
        cells=make("cells", cells),
        sensor_map=make("sensor_map", [(10 + x, 20 + y, x, y) for x, y in cells]),
        stations=make("location_map", [(1, 1)]),
        sides=[(volume, VOLUME_COLUMNS)],
        volume=volume,
    )


@pytest.fixture(scope="module")
def frame(spark, inputs, tmp_path_factory):
    rng = random.Random(1)
    start = datetime(2018, 12, 31, 23)
    seen = [
        (f"s{x}{y}", start + timedelta(hours=h), 10.0 * x + h % 24 + rng.random(), -1.0, 10 + x, 20 + y)
        for x in range(3) for y in range(2) for h in range(0, 31 * 24, 3)
    ]
    observations = spark.createDataFrame(seen, SCHEMAS["observations"])
    out = ft.training_frame(observations, inputs.calendar, inputs.sensor_map, inputs.sides)
    return ft.snapshot(out, str(tmp_path_factory.mktemp("frame")))


def tables(root):
    key = ("model_id", "date_time", "x", "y")

    def predictions(name, by):
        return Table(f"{root}/{name}", SCHEMAS["predictions"], key, by, month_of="date_time")

    return calibration.Outputs(
        at_sensors=predictions("sensors", ("model_id",)),
        at_stations=predictions("stations", ("model_id",)),
        on_grid=predictions("grid", ("model_id", "month", "x")),
        on_grid_year=predictions("year", ("model_id", "month", "x")),
        descriptions=Table(f"{root}/descriptions", SCHEMAS["model_description"], ("model_id",)),
        final_models=Table(f"{root}/final", SCHEMAS["final_models"], ("depvar",)),
        scaling=Table(f"{root}/scaling", SCHEMAS["scaling"], ("x", "y")),
        models=f"{root}/models",
    )


def test_full_run(spark, inputs, frame, tmp_path):
    out = tables(str(tmp_path))
    spec, params = FeatureSpec("q_kfz", FEATURES), BoostParams(2, 3, eta=0.8)
    train = ft.training_data(spark, frame, "q_kfz")

    def run(**options):
        return calibration.calibrate_and_predict(
            train, inputs, out, "q_kfz", "trial", NOW, spec=spec, params=params, **options
        )

    dry = run(dry_run=True)
    assert dry.model_id == 1 and out.descriptions.read(spark).count() == 0
    assert out.on_grid.read(spark).count() == 0

    first = run()
    assert first.model_id == 1 and first.in_sample["r2"] > 0.6
    hours = 60 * 24
    ahead = inputs.calendar.filter(TimeRange.around_today(NOW).predicate()).count()
    assert out.at_sensors.read(spark).count() == 6 * hours
    assert out.at_stations.read(spark).count() == hours
    assert out.on_grid.read(spark).count() == 6 * ahead
    assert out.on_grid_year.read(spark).count() == 0
    factors = out.scaling.read(spark).collect()
    assert len(factors) == 6
    for f in factors:
        assert f["kfz_per_24h_pred"] > 0 and (f["scaling"] == 0 or 0.1 <= f["scaling"] <= 5)
    assert [tuple(r) for r in out.final_models.read(spark).collect()] == [("q_kfz", 1)]

    kept = boosting.load_model(spark, f"{out.models}/1")
    assert predict(frame, kept).exceptAll(predict(frame, first.model)).isEmpty()
    explained = explanation.explain_model(
        frame, f"{out.models}/1", ("mq_name", "date_time"), 0.5, rows=50, store_at=f"{tmp_path}/e", run_id="r1"
    )
    total = sum(F.col(f"shap_{f}") for f in FEATURES) + F.col("shap_bias")
    joined = predict(explained.contributions, kept, bounded=False).withColumn("total", total)
    assert joined.count() == 50 and joined.filter("abs(pred - total) > 1e-6").isEmpty()
    assert explained.importance.agg(F.sum("rel_importance")).first()[0] == pytest.approx(0.5)
    assert spark.read.parquet(f"{tmp_path}/e/effects").filter("run_id = 'r1'").count() == explained.effects.count() > 0

    again = run(chunk_size=2)
    assert again.model_id == 1
    assert out.on_grid.read(spark).count() == 6 * ahead
    assert out.descriptions.read(spark).count() == 1


def test_incomplete_predictions_stop_the_run(inputs):
    with pytest.raises(calibration.IncompleteError):
        calibration.check_complete(inputs.cells, inputs.cells, 2)


def test_one_off_predictions(spark, inputs, tmp_path):
    """A calendar of every sixth hour from 2021 to 2023, in UTC."""
    model = fixed_model(("hour", 12.0), ("x", 0.0), ("traffic_volume", 150.0))
    out, start = tables(str(tmp_path)), datetime(2021, 1, 1)
    hours = [start + timedelta(hours=6 * h) for h in range(3 * 365 * 4)]
    calendar = spark.createDataFrame([(h, None, 0, 0.5) for h in hours], SCHEMAS["calendar"])
    covered = replace(inputs, calendar=calendar)
    calibration.hotspot_predictions(covered, model, 3, out.on_grid)
    calibration.passive_sampler_predictions(covered, inputs.stations, model, 3, out.at_stations)
    study = [h for h in hours if datetime(2021, 10, 31, 23) <= h <= datetime(2022, 10, 31, 22, 59, 59)]
    year = [h for h in hours if datetime(2021, 12, 31, 23) <= h < datetime(2022, 12, 31, 23)]
    grid = out.on_grid.read(spark)
    assert grid.count() == 6 * len(study)
    assert grid.agg(F.min("date_time"), F.max("date_time")).first()[:] == (study[0], study[-1])
    assert sorted(r["date_time"] for r in out.at_stations.read(spark).collect()) == year
    frame = ft.feature_frame(ft.grid_locations(inputs.cells), calendar.filter(F.col("date_time").isin(study)), inputs.sides)
    assert grid.exceptAll(scoring.score_frame(frame, model, 3)).isEmpty()


@pytest.mark.parametrize("chunk_size", [1, math.inf])
def test_backfill_replaces_what_is_stored(spark, inputs, tmp_path, chunk_size):
    model = fixed_model(("hour", 12.0), ("x", 0.0), ("traffic_volume", 150.0))
    table = tables(str(tmp_path)).on_grid
    span = TimeRange.half_open("2019-01-05", "2019-01-07")
    args = (ft.grid_locations(inputs.cells), inputs.calendar, inputs.sides, model, 4, table, span)
    whole = scoring.score_frame(ft.feature_frame(args[0], args[1], args[2], span), model, 4)
    # repeated and outdated rows, others missing; rows of another hour, place and model stay
    some = whole.filter("x = 0 OR (x = 1 AND y = 0)").withColumn("value", F.col("value") + 1)
    others = [(4, datetime(2019, 1, 20), 0, 0, 1.0), (4, datetime(2019, 1, 5, 12), 0, 77, 2.0), (5, datetime(2019, 1, 5, 12), 0, 0, 3.0)]
    others = spark.createDataFrame(others, table.struct)
    for rows in (some, some, others):
        scoring.append(rows, table)
    for _ in range(2):
        assert scoring.score_backfill(*args, chunk_size=chunk_size) == (3 if chunk_size == 1 else 1)
        stored = table.read(spark)
        assert stored.count() == whole.count() + 3 == 6 * 48 + 3
        assert stored.exceptAll(whole.unionByName(others)).isEmpty()


def test_stored_rows_are_not_shuffled_by_keys_of_few_values(spark, inputs, tmp_path, monkeypatch):
    """Whatever Catalyst thinks of the sizes: all rows of a month or a column would meet in one task."""
    model = fixed_model(("hour", 12.0), ("x", 0.0), ("traffic_volume", 150.0))
    table = tables(str(tmp_path)).on_grid
    span = TimeRange.half_open("2019-01-05", "2019-01-06")
    args = (ft.grid_locations(inputs.cells), inputs.calendar, inputs.sides, model, 4, table, span)
    scoring.score_backfill(*args)
    plans, real = [], scoring.replace_partitions
    monkeypatch.setattr(scoring, "replace_partitions", lambda new, to: (plans.append(new), real(new, to)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scoring.score_backfill(*args)
        plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in plan.splitlines() if "LeftSemi" in line or "LeftAnti" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)


@pytest.mark.parametrize("by", [("model_id", "month", "x"), ("model_id", "x"), ("model_id", "month")])
def test_cells_that_left_the_grid_go(spark, inputs, tmp_path, by):
    """A cell of a column that is still there, and a column as a whole; other hours and models stay."""
    model = fixed_model(("hour", 12.0), ("x", 0.0), ("traffic_volume", 150.0))
    table = Table(str(tmp_path / "grid"), SCHEMAS["predictions"], ("model_id", "date_time", "x", "y"), by, month_of="date_time")
    span = TimeRange.half_open("2019-01-05", "2019-01-06")
    args = (ft.grid_locations(inputs.cells), inputs.calendar, inputs.sides, model, 4, table, span)
    whole = scoring.score_frame(ft.feature_frame(args[0], args[1], args[2], span), model, 4)
    noon, later, next_month = datetime(2019, 1, 5, 12), datetime(2019, 1, 20), datetime(2019, 2, 3)
    gone = [(4, noon, 0, 77, 1.0), (4, noon, 9, 0, 2.0), (4, noon, 8, 0, 3.0)]
    staying = [(4, later, 0, 77, 4.0), (4, later, 9, 0, 5.0), (4, next_month, 8, 0, 6.0), (5, noon, 8, 0, 7.0), (5, noon, 0, 77, 8.0)]
    scoring.append(spark.createDataFrame(gone + staying, table.struct), table)
    kept = whole.unionByName(spark.createDataFrame(staying, table.struct))
    for chunk_size in (math.inf, 1) if "x" in by else (math.inf,):
        scoring.score_backfill(*args, chunk_size=chunk_size, all_places=True, dry_run=True)
        scoring.score_backfill(*args, chunk_size=chunk_size, all_places=True)
        stored = table.read(spark)
        assert stored.count() == kept.count() == 6 * 24 + 5
        assert stored.exceptAll(kept).isEmpty()


def test_backfill_goes_on_by_recorded_chunks(spark, inputs, tmp_path, monkeypatch):
    model = fixed_model(("hour", 12.0), ("x", 0.0), ("traffic_volume", 150.0))
    table = tables(str(tmp_path)).on_grid
    span = TimeRange.half_open("2019-01-05", "2019-01-06")
    args = (ft.grid_locations(inputs.cells), inputs.calendar, inputs.sides, model, 4, table, span)
    real, calls = scoring._replace, []

    def breaks_off(*replaced):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(*replaced)

    monkeypatch.setattr(scoring, "_replace", breaks_off)
    with pytest.raises(RuntimeError, match="lost"):
        scoring.score_backfill(*args, chunk_size=1, run_id="a")
    assert table.read(spark).count() == 2 * 24
    assert scoring.score_backfill(*args, chunk_size=1, run_id="a") == 2
    assert table.read(spark).count() == 6 * 24
    assert scoring.score_backfill(*args, chunk_size=1, run_id="a") == 0
    assert scoring.score_backfill(*args, chunk_size=1, run_id="b") == 3
    assert scoring.score_backfill(*args, chunk_size=1, dry_run=True) == 3


def test_temporal_validation(spark, frame, tmp_path):
    spec = FeatureSpec("q_kfz", FEATURES)
    grid = random_grid(spark, 2).withColumns({"nrounds": F.lit(1), "max_depth": F.lit(2)})
    result = validation.temporal_validation(
        frame.drop("v_kfz"), "q_kfz", spec, grid, lambdas=(5.0, 5e5), weeks=1, n_folds=2
    )
    assert result.trials.count() == 2 and result.best_cv.count() == 1
    assert result.in_sample["n"] + result.out_of_sample["n"] == frame.count()
    assert result.best_lambda == 5.0 and result.model.params.reg_lambda == 5.0
    for _ in range(2):
        validation.store_temporal(result, str(tmp_path), "run")
    assert spark.read.parquet(f"{tmp_path}/trials").count() == 2
    assert predict(frame, result.model).count() == frame.count()


@pytest.mark.parametrize("target", ["q_kfz", "v_kfz"])
def test_spatial_validation(spark, frame, target):
    factors = spark.createDataFrame(
        [(10 + x, 20 + y, 2.0) for x in range(3) for y in range(2)], "x bigint, y bigint, scaling double"
    )
    result = validation.spatial_validation(
        frame.withColumn("v_kfz", F.col("q_kfz")), factors, target,
        FeatureSpec(target, FEATURES), BoostParams(2, 2, eta=0.9), n_folds=2, seed=3,
    )
    assert result.predictions.count() == frame.count()
    assert result.per_fold.agg(F.sum("n")).first()[0] == frame.count()
    assert result.per_sensor.count() == 6
    assert -1 <= result.correlation.first()["spearman"] <= 1
    assert result.mean.first()["rmse"] > 0
