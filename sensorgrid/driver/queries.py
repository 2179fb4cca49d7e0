"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.driver.models import fixed_model
from sensorgrid.driver.views import Views
from sensorgrid.functions.timeparts import TimeRange, format_timestamp, local_date, local_time, time_parts
from sensorgrid.operators import boosting, calibrate, evaluate, explain, features, scoring, spatial, splits
from sensorgrid.operators.model import BoostParams, FeatureSpec, best_params, feature_spec, random_grid
from sensorgrid.plans import calibration, manual_counts
from sensorgrid.plans.calibration import Inputs
from sensorgrid.plans.validation import store_result
from sensorgrid.schemas import SCHEMAS
from sensorgrid.session import cut_lineage, work_path
from sensorgrid.sources import registry
from sensorgrid.sources.tables import Table, covered, transfer_registry
from sensorgrid.sources.tables import append as add
from sensorgrid.sources.tables import compact as remove_superseded
from sensorgrid.sources.tables import completeness_check as completeness
from sensorgrid.sources.tables import dedupe_latest as dedupe
from sensorgrid.sources.tables import hour_coverage as coverage
from sensorgrid.sources.tables import transfer_tables as transfer
from sensorgrid.sources.tables import truncate as empty
from sensorgrid.sources.tables import upsert_latest as store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
    return fn


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def factors(v: Views) -> DataFrame:
    """The stored factor table of the other operators: computed once, then read."""
    return cut_lineage(calibrate.calibration_factors(v.volume, v.preds_year))


def of_model(v: Views, model_id: int) -> DataFrame:
    return v.preds_year.filter(F.col("model_id") == model_id)


def scored(v: Views) -> DataFrame:
    """Events with the mean of their user as the prediction."""
    events = v.table("events")
    means = events.groupBy("user_id").agg(F.avg("value").alias("pred"))
    return events.join(means, "user_id").withColumnRenamed("value", "obs")


# --- Calibration ------------------------------------------------------------------------------
@query
def calibration_factors(v):
    out = calibrate.calibration_factors(v.volume, v.preds_year)
    return rounded(out, "kfz_per_24h", "kfz_per_24h_pred", "scaling")


@query
def apply_factors(v):
    out = calibrate.apply_factors(v.preds_year, factors(v), divisor=2)
    return rounded(out.drop("scaling"), "pred")


@query
def scaled_union(v):
    first = factors(v)
    second = first.select("x", "y", F.col("kfz_per_24h").alias("scaling"))
    return rounded(
        calibrate.scaled_union([(of_model(v, 1), first), (of_model(v, 2), second)]),
        "pred",
        digits=9,
    )


@query
def factors_at_sensors(v):
    """Also of cross sections far off, which lead to no sensor."""
    places = v.obs.select("x", "y").distinct()
    far = v.stations.select((F.col("stadt_x") + 1000).alias("x"), F.col("stadt_y").alias("y"))
    sections = places.union(far).select(F.col("y").alias("lat_int"), F.col("x").alias("lon_int"))
    reprojection = places.select(F.col("y").alias("lat_int"), F.col("x").alias("lon_int"), "x", "y")
    return rounded(
        calibrate.factors_at_sensors(sections, reprojection, v.sensor_map, factors(v)), "scaling"
    )


# --- Time -------------------------------------------------------------------------------------
@query
def time_parts_(v):
    orders = v.table("orders").select("o_orderkey", F.col("o_orderdate").alias("date_time"))
    return time_parts(orders).withColumns(
        {"local_date": local_date("date_time"), "text": format_timestamp(local_time("date_time"))}
    )


QUERIES["time_parts"] = QUERIES.pop("time_parts_")


@query
def time_range(v):
    as_of = datetime(1999, 5, 16, 12, 30)
    ranges = {
        "in_year": TimeRange.local_year(1998),
        "in_closed": TimeRange.closed("1996-11-01 00:00:00", "1997-10-31 23:59:59"),
        "in_half_open": TimeRange.half_open("1997-01-01", "1998-01-01"),
        "in_since": TimeRange.since("1995-06-01", as_of),
        "in_around": TimeRange.around_today(as_of),
    }
    return v.table("orders").select(
        "o_orderkey", *[r.predicate("o_orderdate").alias(n) for n, r in ranges.items()]
    )


# --- Frames -----------------------------------------------------------------------------------
@query
def cell_features(v):
    return features.cell_features(v.cells.select("x", "y"), v.sides)


@query
def training_frame(v):
    targets = {"q_kfz": "q_kfz", "v_kfz": "v_kfz"}
    return features.training_frame(v.obs, v.calendar, v.sensor_map, v.sides, targets)


@query
def feature_frame(v):
    return features.feature_frame(features.grid_locations(v.cells), v.calendar, v.sides)


@query
def feature_frame_sensors(v):
    return features.feature_frame(
        features.sensor_locations(v.cells, v.sensor_map),
        v.calendar,
        v.sides,
        TimeRange.around_today(datetime(2024, 1, 10, 9)),
    )


@query
def feature_frame_stations(v):
    return features.feature_frame(
        features.mapped_locations(v.stations),
        v.calendar,
        v.sides,
        TimeRange.half_open("2024-01-08", "2024-02-05"),
    )


@query
def incremental_scan(v):
    events = v.table("events").select("event_id", "ts", "event_type")
    return features.incremental_scan(
        events,
        v.table("lineitem"),
        ts="ts",
        target_ts="l_shipdate",
        upper=TimeRange.until(datetime(2023, 11, 2, 12)),
    )


def _known(v: Views) -> DataFrame:
    return v.obs.select("event_id", "mq_name", "date_time", "q_kfz")


@query
def drop_sentinel(v):
    return features.drop_sentinel(_known(v), "q_kfz")


@query
def hash_sample(v):
    return features.hash_sample(_known(v), 0.1, ["event_id"], seed=11)


@query
def sample_n(v):
    return features.sample_n(_known(v), 700, ["event_id"], seed=5)


@query
def sample_fraction(v):
    return features.sample_fraction(_known(v), 0.02, ["event_id"], seed=3)


# --- Splits -----------------------------------------------------------------------------------
@query
def avg_sensors_per_hour(v):
    return rounded(splits.avg_sensors_per_hour(v.obs), "avg_sensors")


@query
def temporal_split(v):
    return splits.temporal_split(v.table("orders"), "o_orderdate").select("o_orderkey", "split")


@query
def expanding_folds(v):
    out = splits.expanding_folds(v.table("orders"), mode="time", ts="o_orderdate")
    return out.select("o_orderkey", "fold_1", "fold_2", "fold_3", "fold_4")


@query
def expanding_folds_rows(v):
    rows = v.obs.select("event_id", "date_time", "x", "y")
    return splits.expanding_folds(rows, mode="rows", tie=["event_id"], weeks=1)


@query
def group_folds(v):
    return splits.group_folds(v.obs.select("event_id", "mq_name"), seed=42)


# --- Evaluation -------------------------------------------------------------------------------
_METRICS = ("rmse", "r2", "r2_corr", "mae")


@query
def regression_metrics(v):
    return rounded(evaluate.regression_metrics(scored(v), "obs", "pred"), *_METRICS)


@query
def metrics_by_group(v):
    return rounded(evaluate.metrics_by_group(scored(v), "event_type", "obs", "pred"), *_METRICS)


@query
def mean_metrics(v):
    per_group = evaluate.metrics_by_group(scored(v), "event_type", "obs", "pred")
    return rounded(evaluate.mean_metrics(per_group), "rmse", "r2", "mae")


@query
def sensor_summary(v):
    cells = factors(v).select(F.col("x").alias("stadt_x"), F.col("y").alias("stadt_y"), "scaling")
    by_sensor = v.sensor_map.join(cells, ["stadt_x", "stadt_y"], "left").select(
        F.col("det_x").alias("x"), F.col("det_y").alias("y"), "scaling"
    )
    rows = v.obs.join(by_sensor, ["x", "y"], "left")
    out = evaluate.sensor_summary(rows, obs="q_kfz", pred="v_kfz", scaling="scaling")
    return rounded(out, "pred", "obs", "scaling", digits=9)


@query
def sensor_correlation(v):
    summary = evaluate.sensor_summary(v.obs, obs="q_kfz", pred="v_kfz")
    summary = summary.withColumn("pred", F.floor("pred").cast("double"))
    return rounded(evaluate.sensor_correlation(summary), "pearson", "spearman")


@query
def residuals(v):
    return rounded(evaluate.residuals(scored(v), "obs", keep=["event_id"]), "pred", "resid", digits=9)


@query
def distribution_table(v):
    return rounded(evaluate.distribution_table(scored(v), "obs", by=["event_type"]), "bin_start")


# --- Places -----------------------------------------------------------------------------------
def _matches(v: Views) -> DataFrame:
    located = spatial.nearest_cell(v.points, v.cell_coords)
    return spatial.match_streets(located, v.cell_streets, v.street_names)


@query
def nearest_cell(v):
    return spatial.nearest_cell(v.points, v.cell_coords)


@query
def match_streets(v):
    return _matches(v)


@query
def cells_of_streets(v):
    return spatial.cells_of_streets(_matches(v), v.cell_streets)


@query
def compare_at_points(v):
    stored = factors(v)
    vintages = [(of_model(v, 1), stored), (of_model(v, 2), stored)]
    out = spatial.compare_at_points(
        v.points, v.cell_coords, v.cell_streets, v.street_names, vintages
    )
    return rounded(out, "pred")


# --- Models -----------------------------------------------------------------------------------
PRICE = FeatureSpec("l_extendedprice", ("l_quantity", "l_discount", "l_tax", "l_linenumber"))
ROW = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
PRICE_MODEL = fixed_model(("l_quantity", 24.5), ("l_discount", 0.045), ("l_tax", 0.035))
GRID_MODEL = fixed_model(("hour", 12.0), ("x", 4.0), ("traffic_volume", 900.0))


@query
def fit_boosted(v):
    """Two boosted stumps on all line items."""
    params = BoostParams(2, 1, eta=0.5, gamma=1.0, reg_lambda=5000.0)
    model = boosting.fit_boosted(v.table("lineitem"), PRICE, params, row_key=ROW)
    out = model.node_frame(v.spark).withColumn("gain", F.col("gain") / F.col("cover"))
    out = out.select("tree", "node", "feature", "threshold", "weight", "cover", "gain")
    return rounded(out, "threshold", "weight", digits=6).withColumn("gain", F.round("gain", 3))


@query
def predict(v):
    out = boosting.predict(v.table("lineitem"), PRICE_MODEL)
    return out.select(*ROW, F.round("pred", 6).alias("pred"))


@query
def load_model(v):
    """Predictions of the model after saving and loading it."""
    path = work_path(v.spark, "model")
    boosting.save_model(v.spark, PRICE_MODEL, path)
    out = boosting.predict(v.table("lineitem"), boosting.load_model(v.spark, path))
    return out.select(*ROW, F.round("pred", 6).alias("pred"))


def _grid(v: Views) -> DataFrame:
    return features.feature_frame(features.grid_locations(v.cells), v.calendar, v.sides)


def _predictions(v: Views, name: str, *by: str) -> Table:
    key = ("model_id", "date_time", "x", "y")
    return Table(work_path(v.spark, name), SCHEMAS["predictions"], key, by, month_of="date_time")


@query
def score(v):
    """Stored twice, the second time with other values for the same keys."""
    table = _predictions(v, "scored", "model_id", "month")
    scoring.score(_grid(v).withColumn("traffic_volume", F.lit(0.0)), GRID_MODEL, 7, table)
    scoring.score(_grid(v), GRID_MODEL, 7, table)
    return table.read(v.spark)


def _backfill(v: Views, table: Table, sides, **options) -> None:
    scoring.score_backfill(
        features.grid_locations(v.cells), v.calendar, sides, GRID_MODEL, 7, table, **options
    )


@query
def score_backfill(v):
    """Run, and run again after the volumes changed."""
    table = _predictions(v, "grid", "model_id", "month", "x")
    before = v.volume.withColumn("kfz_per_24h", F.lit(0.0))
    streets, land, (_, names), houses = v.sides
    _backfill(v, table, [streets, land, (before, names), houses])
    _backfill(v, table, v.sides)
    return table.read(v.spark)


@query
def score_backfill_repair(v):
    """A table with repeated, missing and outdated rows, scored anew in recorded chunks."""
    table = _predictions(v, "grid", "model_id", "month", "x")
    some = scoring.score_frame(_grid(v), GRID_MODEL, 7).filter("y % 2 = 0 AND x < 7")
    add(some.withColumn("value", F.col("value") + 1), table)
    add(some, table)
    _backfill(v, table, v.sides, chunk_size=4, run_id="repair")
    _backfill(v, table, v.sides, chunk_size=4, run_id="repair")
    return table.read(v.spark)


@query
def refresh_calibration(v):
    year = _predictions(v, "year", "model_id", "month", "x")
    scaling = Table(work_path(v.spark, "scaling"), SCHEMAS["scaling"], ("x", "y"))
    inputs = Inputs(v.calendar, v.cells, v.sensor_map, v.stations, v.sides, v.volume)
    calibration.refresh_calibration(
        inputs, GRID_MODEL, 7, year, scaling, TimeRange.half_open("2024-01-08", "2024-01-22")
    )
    return rounded(scaling.read(v.spark), "kfz_per_24h", "kfz_per_24h_pred", "scaling")


@query
def prepare_predictions(v):
    predictions = v.preds_year.withColumn("value", F.col("value") / 4)
    return scoring.prepare_predictions(predictions, 99)


@query
def chunk_keys(v):
    return scoring.chunk_keys(v.cells.select("x").distinct(), "x", 4)


# --- Stored tables ----------------------------------------------------------------------------
def _versions(v: Views) -> DataFrame:
    """Order rows as versions of a record per customer and priority."""
    return v.table("orders").select(
        "o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey", "o_totalprice"
    )


@query
def dedupe_latest(v):
    return dedupe(_versions(v), ["o_custkey", "o_orderpriority"], ["o_orderdate"])


@query
def upsert_latest(v):
    """Model 1's predictions replaced by model 2's where both have the cell and the time."""
    daily = v.preds_year.groupBy("model_id", "date_time", "x", "y").agg(F.max("value").alias("value"))
    key = ("date_time", "x", "y")
    schema = "date_time timestamp_ntz, x bigint, y bigint, value double"
    table = Table(work_path(v.spark, "upsert"), schema, key, ("x",))
    for model_id in (1, 2):
        store(daily.filter(F.col("model_id") == model_id).drop("model_id"), table)
    return table.read(v.spark)


def _sums(v: Views) -> tuple[DataFrame, Table]:
    """Quantity per ship date and supplier cell, and a table for it."""
    sums = v.preds_year.groupBy("date_time", "x", "y").agg(F.sum("value").alias("value"))
    schema = "date_time timestamp_ntz, x bigint, y bigint, value double"
    return sums, Table(work_path(v.spark, "sums"), schema, ("date_time", "x", "y"), ("x",), "value")


@query
def append(v):
    """Two appends leave both rows of a key."""
    sums, table = _sums(v)
    add(sums, table)
    add(sums.withColumn("value", F.col("value") + 1), table)
    return table.read(v.spark)


@query
def compact(v):
    """The later of two appended rows of a key stays."""
    sums, table = _sums(v)
    add(sums, table)
    add(sums.withColumn("value", F.col("value") + 1), table)
    remove_superseded(v.spark, table)
    return table.read(v.spark)


@query
def truncate(v):
    """Rows written before the truncation are gone."""
    sums, table = _sums(v)
    add(sums.withColumn("value", F.col("value") + 1), table)
    empty(v.spark, table)
    add(sums, table)
    return table.read(v.spark)


@query
def snapshot(v):
    return features.snapshot(v.obs, work_path(v.spark, "snapshot"), ["x"])


def _transferred(v: Views) -> tuple[DataFrame, DataFrame]:
    """Factors and predictions copied between two schemas; a missing table is reported.

    The target holds model 2's predictions plus one, as if they were model 1's.
    """
    root = work_path(v.spark, "transfer")
    specs = transfer_registry()
    scaling, stations = specs["traffic_model_scaling"], specs["traffic_model_predictions_stations"]
    add(factors(v), scaling.at(root, scaling.source_schema))
    daily = v.preds_year.groupBy("model_id", "date_time", "x", "y").agg(F.max("value").alias("value"))
    add(daily.filter("model_id = 1"), stations.at(root, stations.source_schema))
    target = stations.at(root, stations.target_schema)
    older = daily.filter("model_id = 2").withColumn("value", F.col("value") + 1)
    add(older.withColumn("model_id", F.lit(1).cast("bigint")), target)
    missing = specs["traffic_models_final"]
    report, _ = transfer(v.spark, root, [scaling, missing, stations])
    return report, target.read(v.spark)


@query
def transfer_tables(v):
    return _transferred(v)[1]


@query
def transfer_report(v):
    return _transferred(v)[0].select("table", "ok", "rows")


@query
def completeness_check(v):
    """Stored predictions: all, without a column of cells, and without an hour."""
    table = _predictions(v, "arrived", "model_id", "x")
    add(scoring.score_frame(_grid(v), GRID_MODEL, 7), table)
    stored = table.read(v.spark)
    first_hour = v.calendar.agg(F.min("date_time").alias("h")).scalar()
    without_hour = stored.filter(F.col("date_time") != first_hour)
    parts = [
        ("all", 0, stored),
        ("a column less", 0, stored.filter("x <> 3")),
        ("an hour less", 0, without_hour),
        ("an hour less", 1, without_hour),
    ]
    checked = [
        completeness(rows, v.cells, v.calendar, (-1, 0, 1) if slack else (0,)).select(
            F.lit(name).alias("part"), F.lit(slack).alias("slack"), "*"
        )
        for name, slack, rows in parts
    ]
    return reduce(DataFrame.unionByName, checked)


@query
def resolve_model_id(v):
    """Orders as registered models; the described models are these and three new ones."""
    registered = v.table("orders").select(
        (F.col("o_orderkey") + 1).alias("model_id"),
        F.col("o_orderdate").alias("date_time"),
        F.col("o_orderpriority").alias("model_name"),
        F.concat_ws("/", "o_orderstatus", F.col("o_custkey").cast("string")).alias("description"),
    )
    described = registered.withColumn("model_id", F.lit(None).cast("bigint"))
    changed = described.agg(
        F.max("date_time").alias("date_time"),
        F.min("model_name").alias("model_name"),
        F.explode(F.array(*[F.lit(f"new {k}") for k in (1, 2, 3)])).alias("description"),
    ).select(F.lit(None).cast("bigint").alias("model_id"), "*")
    return registry.resolve_model_id(described.unionByName(changed), registered)


@query
def describe_model(v):
    spec = FeatureSpec("q_kfz", ("x", "y", "hour"))
    return registry.describe_model(v.obs, spec, best_params("q_kfz"), "trial")


@query
def set_final_model(v):
    """The newest order per status as the production model of a target."""
    table = Table(work_path(v.spark, "final"), SCHEMAS["final_models"], ("depvar",))
    models = v.table("orders").groupBy(F.col("o_orderstatus").alias("depvar")).agg(
        F.max("o_orderkey").alias("model_id")
    )
    targets = models.collect()  # one row per status
    for model_id in (lambda r: 0, lambda r: r["model_id"]):
        for row in targets:
            registry.set_final_model(v.spark, table, row["depvar"], model_id(row))
    return table.read(v.spark)


# --- Search results and explanation -----------------------------------------------------------
def _trials(v: Views) -> DataFrame:
    """Orders as trials: the price stands for the error."""
    return v.table("orders").select(
        F.col("o_orderkey").alias("trial"),
        F.col("o_orderpriority").alias("setting"),
        F.col("o_totalprice").alias("rmse"),
    )


@query
def best_trial(v):
    return boosting.best_trial(_trials(v))


@query
def search_results(v):
    return boosting.search_results(boosting.best_trial(_trials(v)).select("setting"), _trials(v))


def _nodes(v: Views) -> DataFrame:
    """Line items as tree nodes: splits on one of seven features, and leaves."""
    names = ["land_water", "str_class_I", "building_height", "summer_holidays", "x", "hour"]
    feature = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("l_linenumber").cast("int"))
    return v.table("lineitem").select(
        F.when(F.col("l_linenumber") <= len(names), feature).alias("feature"),
        F.col("l_quantity").alias("gain"),
    )


@query
def feature_importance(v):
    out = explain.feature_importance(_nodes(v), r2=0.75, top=10)
    return rounded(out, "importance", "rel_importance")


@query
def importance_by_group(v):
    return rounded(explain.importance_by_group(explain.feature_importance(_nodes(v))), "imp")


@query
def shap_contributions(v):
    out = explain.shap_contributions(v.table("lineitem"), PRICE_MODEL, keep=ROW)
    return rounded(out, "shap_l_quantity", "shap_l_discount", "shap_l_tax", "shap_bias")


@query
def shap_effects(v):
    explained = explain.shap_contributions(v.table("lineitem"), PRICE_MODEL)
    out = explain.shap_effects(explained, PRICE_MODEL.spec.features, bins=5)
    return rounded(out, "mean_value", "mean_contribution")


# --- Search and validation: one round of depth 1 for each fit, which SQL can state -------------
STUMP = BoostParams(1, 1, eta=0.5, reg_lambda=5.0)


@query
def search(v):
    folded = splits.time_folds(v.table("lineitem"), "l_shipdate", weeks=52, n_folds=2)
    whole = {"nrounds": F.lit(1), "max_depth": F.lit(1), "min_child_weight": F.lit(1)}
    shares = {"colsample_bytree": F.lit(1.0), "subsample": F.lit(1.0)}
    grid = random_grid(v.spark, 2, seed=3).withColumns(whole | shares)
    found = boosting.search(folded, PRICE, grid, ["fold_1", "fold_2"])
    return rounded(found, "eta", "gamma", "rmse", "r2_corr", "mae")


@query
def lambda_sweep(v):
    split = splits.temporal_split(v.table("lineitem"), "l_shipdate", weeks=52)
    train, test = (split.filter(F.col("split") == s) for s in ("train", "test"))
    found = boosting.lambda_sweep(train, test, PRICE, STUMP, lambdas=(5.0, 5000.0))
    return rounded(found, *[c for c in found.columns if c != "lambda"])


@query
def spatial_cv(v):
    folded = splits.group_folds(v.table("lineitem"), "l_suppkey", n_folds=2, seed=1)
    out = boosting.spatial_cv(folded, PRICE, STUMP, folds=(1, 2))
    return out.select(*ROW, "fold", "l_extendedprice", F.round("pred", 6).alias("pred"))


# --- What the queries above leave out ----------------------------------------------------------
@query
def predictor_frame(v):
    """The 26 predictors of the model formula beside the observation they belong to."""
    spec = feature_spec("q_kfz")
    targets = {"q_kfz": "q_kfz", "v_kfz": "v_kfz"}
    frame = features.training_frame(v.obs, v.calendar, v.sensor_map, v.sides, targets)
    return frame.select("mq_name", "date_time", spec.target, *spec.features)


@query
def on_local_days(v):
    """Observations of three local days, one of them without any."""
    days = (date(2024, 1, 15), date(2024, 1, 16), date(1999, 5, 4))
    return spatial.on_local_days(v.obs.select("event_id", "date_time"), days)


@query
def counting_points(v):
    """The cells nearest to the manual counting points."""
    return spatial.nearest_cell(manual_counts.counting_points(v.spark), v.cell_coords)


@query
def feature_importance_top(v):
    """The ten most important of 26 features."""
    nodes = v.table("lineitem").select(
        F.concat(F.lit("f"), F.col("l_partkey") % 26).alias("feature"), F.col("l_quantity").alias("gain")
    )
    return rounded(explain.feature_importance(nodes, r2=0.75, top=10), "importance", "rel_importance")


@query
def shap_effects_top(v):
    """Effects of the two strongest of three features."""
    explained = explain.shap_contributions(v.table("lineitem"), PRICE_MODEL)
    strongest = explain.top_effects(explained, PRICE_MODEL.spec.features, top=2)
    return rounded(explain.shap_effects(explained, strongest, bins=5), "mean_value", "mean_contribution")


@query
def dry_run(v):
    """Neither an append nor a replacement without writing changes what is stored."""
    sums, table = _sums(v)
    add(sums, table)
    more = sums.withColumn("value", F.col("value") + 1)
    add(more, table, dry_run=True)
    store(more, table, dry_run=True)
    return table.read(v.spark)


@query
def stored_results(v):
    """Two runs' errors by group under their ids; the first run was repeated."""
    path = work_path(v.spark, "results")
    by_type = metrics_by_group(v)
    store_result(by_type.withColumn("n", F.lit(0).cast("bigint")), path, "first")
    store_result(by_type, path, "second")
    store_result(by_type, path, "first")
    return v.spark.read.parquet(path)


@query
def score_passive_samplers(v):
    """A stored model, loaded, over the samplers' year; the calendar is moved into it."""
    path = work_path(v.spark, "model")
    boosting.save_model(v.spark, GRID_MODEL, path)
    moved = v.calendar.withColumn("date_time", F.col("date_time") - F.make_dt_interval(F.lit(728)))
    inputs = Inputs(moved, v.cells, v.sensor_map, v.stations, v.sides, v.volume)
    table = _predictions(v, "passive", "model_id", "month")
    model = boosting.load_model(v.spark, path)
    calibration.passive_sampler_predictions(inputs, v.stations, model, 7, table)
    return table.read(v.spark)


@query
def prepare_without_id(v):
    """Predictions to store without a model id have no such column."""
    out = of_model(v, 1).drop("model_id").withColumnRenamed("value", "pred")
    return scoring.prepare_predictions(out.withColumnRenamed("pred", "value"), None)


def _with_gaps(v: Views) -> DataFrame:
    """A model's hours at each cell: a cell is missing, one lacks an hour and has another twice."""
    sums = v.preds_year.select("date_time", "x", "y", "value")
    return sums.filter("x <> 3").unionByName(sums.filter("x = 4"))


@query
def hour_coverage(v):
    """The hours of each cell that are there, by bitmaps; repeated rows do not make up for gaps."""
    hours = v.preds_year.select("date_time").distinct()
    return coverage(_with_gaps(v), v.cells, hours)


@query
def hours_covered(v):
    hours = v.preds_year.select("date_time").distinct()
    return covered(coverage(_with_gaps(v), v.cells, hours))


@query
def fit_boosted_deep(v):
    """Trees of depth 3 on samples of rows and features, until the error of the last year stops falling."""
    split = splits.temporal_split(v.table("lineitem"), "l_shipdate", weeks=52)
    train, test = (split.filter(F.col("split") == s) for s in ("train", "test"))
    params = BoostParams(
        20, 3, eta=0.6, gamma=1e6, reg_lambda=50.0, min_child_weight=20, colsample_bytree=0.75, subsample=0.8
    )
    return boosting.fit_boosted(train, PRICE, params, test, early_stopping_rounds=2, row_key=ROW).node_frame(v.spark)
