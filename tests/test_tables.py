import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sensorgrid.operators.model import FeatureSpec, best_params
from sensorgrid.schemas import SCHEMAS
from sensorgrid.session import Stage
from sensorgrid.sources import registry
from sensorgrid.sources import tables as tb

SCHEMA = "x bigint, y bigint, v double"


@pytest.fixture
def table(tmp_path):
    return tb.Table(str(tmp_path / "t"), SCHEMA, ("x", "y"), ("x",))


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def contents(spark, table):
    return sorted(tuple(r) for r in table.read(spark).collect())


@pytest.mark.parametrize("partition_by", [("x",), ()])
def test_upsert_replaces_by_key_and_is_idempotent(spark, tmp_path, partition_by):
    table = tb.Table(str(tmp_path / "t"), SCHEMA, ("x", "y"), partition_by)
    assert contents(spark, table) == []
    tb.upsert_latest(frame(spark, (1, 1, 1.0), (1, 2, 2.0), (2, 1, 3.0)), table)
    new = frame(spark, (1, 2, 20.0), (3, 3, 30.0))
    for _ in range(2):
        tb.upsert_latest(new, table)
        assert contents(spark, table) == [(1, 1, 1.0), (1, 2, 20.0), (2, 1, 3.0), (3, 3, 30.0)]


def test_upsert_leaves_other_partitions_untouched(spark, table, tmp_path):
    tb.upsert_latest(frame(spark, (1, 1, 1.0), (2, 1, 3.0)), table)
    before = {p.name for p in (tmp_path / "t" / "x=2").glob("*.parquet")}
    tb.upsert_latest(frame(spark, (1, 1, 2.0)), table)
    assert {p.name for p in (tmp_path / "t" / "x=2").glob("*.parquet")} == before


def test_version_decides_between_old_and_new(spark, tmp_path):
    table = tb.Table(str(tmp_path / "t"), SCHEMA, ("x", "y"), ("x",), version="v")
    tb.upsert_latest(frame(spark, (1, 1, 5.0)), table)
    tb.upsert_latest(frame(spark, (1, 1, 4.0)), table)
    assert contents(spark, table) == [(1, 1, 5.0)]


def test_dry_run_writes_nothing(spark, table):
    for sink in (tb.append, tb.upsert_latest):
        sink(frame(spark, (1, 1, 1.0)), table, dry_run=True)
    assert contents(spark, table) == []


def test_append_then_compact(spark, table, tmp_path):
    tb.append(frame(spark, (1, 1, 1.0), (2, 1, 3.0)), table)
    tb.append(frame(spark, (1, 1, 2.0)), table)
    assert table.read(spark).count() == 3
    before = {p.name for p in (tmp_path / "t" / "x=2").glob("*.parquet")}
    tb.compact(spark, table)
    assert contents(spark, table) == [(1, 1, 2.0), (2, 1, 3.0)]
    assert {p.name for p in (tmp_path / "t" / "x=2").glob("*.parquet")} == before


def test_compact_within_a_partition(spark, table):
    for _ in range(2):
        tb.append(frame(spark, (1, 1, 1.0), (2, 1, 3.0)), table)
    tb.compact(spark, table, {"x": 1})
    assert contents(spark, table) == [(1, 1, 1.0), (2, 1, 3.0), (2, 1, 3.0)]
    with pytest.raises(ValueError, match="not a partition column"):
        tb.compact(spark, table, {"y": 1})


def records(tmp_path):
    return list((tmp_path / "t_appends").glob("append_id=*"))


def test_compaction_reads_only_what_appends_have_touched(spark, table, tmp_path):
    tb.upsert_latest(frame(spark, (1, 1, 1.0), (2, 1, 3.0), (3, 1, 4.0)), table)
    tb.append(frame(spark, (2, 1, 5.0), (2, 2, 6.0)), table)
    tb.append(frame(spark, (3, 2, 7.0)), table)
    assert len(records(tmp_path)) == 2
    for file in (tmp_path / "t" / "x=1").glob("*.parquet"):
        file.write_bytes(b"not read")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    tb.compact(spark, table)
    rest = table.read(spark).filter("x > 1")
    assert sorted(tuple(r) for r in rest.collect()) == [(2, 1, 5.0), (2, 2, 6.0), (3, 1, 4.0), (3, 2, 7.0)]
    assert records(tmp_path) == []
    before = sorted(p.name for p in (tmp_path / "t").rglob("*.parquet"))
    tb.compact(spark, table)
    assert sorted(p.name for p in (tmp_path / "t").rglob("*.parquet")) == before


def test_an_append_that_breaks_off_is_recorded(spark, table, tmp_path, monkeypatch):
    tb.append(frame(spark, (1, 1, 1.0)), table)
    tb.compact(spark, table)
    real = tb._write

    def broken(df, into, mode):
        real(df, into, mode)
        if into.path == table.path:
            raise OSError("lost")

    monkeypatch.setattr(tb, "_write", broken)
    with pytest.raises(OSError, match="lost"):
        tb.append(frame(spark, (1, 1, 2.0)), table)
    monkeypatch.undo()
    assert contents(spark, table) == [(1, 1, 1.0), (1, 1, 2.0)]
    tb.compact(spark, table)
    assert contents(spark, table) == [(1, 1, 2.0)]


def test_compaction_within_a_partition_keeps_the_record_of_the_others(spark, table, tmp_path):
    for value in (1.0, 2.0):
        tb.append(frame(spark, (1, 1, value), (2, 1, value)), table)
    tb.compact(spark, table, {"x": 1})
    assert contents(spark, table) == [(1, 1, 2.0), (2, 1, 1.0), (2, 1, 2.0)] and len(records(tmp_path)) == 2
    tb.compact(spark, table)
    assert contents(spark, table) == [(1, 1, 2.0), (2, 1, 2.0)] and records(tmp_path) == []


@pytest.mark.parametrize("partition_by", [("x",), ()])
def test_rows_that_something_else_wrote_are_compacted_on_request(spark, tmp_path, partition_by):
    table = tb.Table(str(tmp_path / "t"), SCHEMA, ("x", "y"), partition_by)
    for value in (1.0, 2.0):
        tb._write(frame(spark, (1, 1, value)), table, "append")
    tb.compact(spark, table)
    assert contents(spark, table) == [(1, 1, 1.0), (1, 1, 2.0)]
    tb.compact(spark, table, recorded=False)
    assert contents(spark, table) == [(1, 1, 2.0)]


def test_null_keys_in_appends_are_refused_by_compaction(spark, table):
    for row in ((None, 1, 1.0), (1, None, 1.0)):
        tb.append(frame(spark, row), table)
        with pytest.raises(ValueError, match="NULL in the key"):
            tb.compact(spark, table)


def test_an_upsert_neither_sorts_nor_shuffles_the_old_rows(spark, tmp_path):
    for name, rows in (("old", 10_000), ("new", 10)):
        data = spark.range(rows).select(F.col("id").alias("x"), F.col("id").alias("y"), F.rand(1).alias("v"))
        data.write.parquet(str(tmp_path / name))
    old, new = (spark.read.parquet(str(tmp_path / name)) for name in ("old", "new"))
    merged = tb.merge_latest(old, new, ("x", "y"))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # of the new rows
    assert merged.count() == 10_000


def test_many_new_keys_are_not_broadcast_however_few_bytes_they_take(spark, tmp_path):
    """A million regular keys are a file of few bytes, but too much for the driver."""
    data = spark.range(0, 1_000_000, 1, 1)
    data = data.selectExpr("id DIV 1000000 AS x", "bigint(id DIV 1000) AS y", "id % 1000 AS z", "1D AS v")
    data.write.parquet(str(tmp_path / "new"))
    new = spark.read.parquet(str(tmp_path / "new"))
    plan = tb.merge_latest(new, new, ("x", "y", "z"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("pruned", [5_000, 1])
def test_stored_rows_are_not_shuffled_by_their_partition(spark, tmp_path, monkeypatch, pruned):
    """Whatever Catalyst thinks of the sizes: all rows of a partition would meet in one task."""
    table = tb.Table(str(tmp_path / "t"), SCHEMA, ("x", "y"), ("x", "y"))
    tb.upsert_latest(frame(spark, (1, 1, 1.0), (1, 2, 2.0), (2, 1, 3.0), (2, 2, 4.0)), table)
    monkeypatch.setattr(tb, "PRUNED_PARTITIONS", pruned)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = tb._partitions_of(table.scan(spark), frame(spark, (1, 2, 0.0), (2, 1, 0.0), (2, 1, 9.0)), table)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(tuple(r) for r in found.collect()) == [(1, 2, 2.0), (2, 1, 3.0)]


def test_repeated_new_rows_give_one_row(spark, table):
    tb.upsert_latest(frame(spark, (1, 1, 1.0), (1, 2, 9.0)), table)
    tb.upsert_latest(frame(spark, (1, 1, 2.0), (1, 1, None), (1, 1, 3.0), (1, 1, 3.0)), table)
    assert contents(spark, table) == [(1, 1, 3.0), (1, 2, 9.0)]


def test_many_partitions_are_found_by_the_join_alone(spark, table, monkeypatch):
    monkeypatch.setattr(tb, "PRUNED_PARTITIONS", 1)
    tb.upsert_latest(frame(spark, (1, 1, 1.0), (2, 1, 3.0), (3, 1, 4.0)), table)
    tb.upsert_latest(frame(spark, (1, 1, 2.0), (2, 2, 5.0)), table)
    assert contents(spark, table) == [(1, 1, 2.0), (2, 1, 3.0), (2, 2, 5.0), (3, 1, 4.0)]


def test_a_stage_gives_its_space_back(spark, tmp_path):
    stage = Stage(spark, "test")
    first = stage.put(spark.range(1000))
    path = Path(stage.path.removeprefix("file:"))
    second = stage.put(first.filter("id < 10"))
    assert second.count() == 10
    assert not path.exists()
    stage.clear()
    stage.clear()


@pytest.mark.parametrize("partition_by", [("x",), ()])
def test_truncate_keeps_the_table_usable(spark, tmp_path, partition_by):
    table = tb.Table(str(tmp_path / "t"), SCHEMA, ("x", "y"), partition_by)
    tb.append(frame(spark, (1, 1, 1.0)), table)
    tb.truncate(spark, table)
    assert contents(spark, table) == [] and table.read(spark).columns == ["x", "y", "v"]
    tb.append(frame(spark, (1, 1, 2.0)), table)
    assert contents(spark, table) == [(1, 1, 2.0)]


def test_key_is_required(spark, table):
    with pytest.raises(ValueError, match="NULL in the key"):
        tb.upsert_latest(frame(spark, (1, None, 1.0)), table)
    with pytest.raises(ValueError, match="missing columns"):
        tb.upsert_latest(frame(spark, (1, 1, 1.0)).drop("y"), table)
    with pytest.raises(ValueError, match="without a key"):
        tb.require_key(frame(spark, (1, 1, 1.0)), tb.Table("p", SCHEMA, ()))
    with pytest.raises(ValueError, match="not part of the key"):
        tb.Table("p", SCHEMA, ("x",), ("v",))


def test_dedupe_limits_rows_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("k"), "id")
    out = tb.dedupe_latest(df, ["k"], ["id"])
    assert {tuple(r) for r in out.collect()} == {(0, 9999), (1, 9997), (2, 9998)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_transfer_isolates_errors(spark, tmp_path):
    root = str(tmp_path)
    specs = tb.transfer_registry()
    assert list(specs) == [
        "traffic_model_predictions_stations", "traffic_model_predictions_grid",
        "traffic_models_final", "traffic_model_scaling", "traffic_model_description",
    ]
    final, scaling = specs["traffic_models_final"], specs["traffic_model_scaling"]
    rows = spark.createDataFrame([("q_kfz", 3), ("v_kfz", 4)], SCHEMAS["final_models"])
    tb.append(rows, final.at(root, final.source_schema))
    tb.append(rows.limit(1), final.at(root, final.target_schema))
    tb.append(rows.limit(1), final.at(root, final.target_schema))
    report, status = tb.transfer_tables(spark, root, [scaling, final])
    got = {r["table"]: r for r in report.collect()}
    assert status == 1 and not got["traffic_model_scaling"]["ok"] and got["traffic_model_scaling"]["error"]
    assert got["traffic_models_final"]["rows"] == 2
    assert contents(spark, final.at(root, final.target_schema)) == [("q_kfz", 3), ("v_kfz", 4)]
    assert tb.transfer_tables(spark, root, [final])[1] == 0


def test_failed_copy_still_cleans_the_target(spark, tmp_path):
    root, spec = str(tmp_path), tb.transfer_registry()["traffic_models_final"]
    target = spec.at(root, spec.target_schema)
    row = spark.createDataFrame([("q_kfz", 3)], SCHEMAS["final_models"])
    tb.append(row, target)
    tb.append(row, target)
    assert tb.transfer_tables(spark, root, [spec])[1] == 1
    assert contents(spark, target) == [("q_kfz", 3)]


@pytest.mark.parametrize("hours, slack, arrived", [(5, (0,), True), (6, (0,), False), (6, (-1, 0, 1), True)])
def test_completeness(spark, hours, slack, arrived):
    cells = spark.range(9)
    predictions = spark.range(45)
    row = tb.completeness_check(predictions, cells, hours, slack).first()
    assert (row["n"], row["all_preds_arrived"]) == (45, arrived)
    assert tb.completeness_check(predictions, cells, spark.range(5)).first()["all_preds_arrived"]


def test_model_ids(spark, tmp_path):
    times = [(datetime(2023, 1, 1),), (datetime(2023, 3, 1, 5),)]
    train = spark.createDataFrame(times, "date_time timestamp_ntz")
    spec = FeatureSpec("q_kfz", ("x", "y"))
    described = registry.describe_model(train, spec, best_params("q_kfz"), "m")
    table = tb.Table(str(tmp_path / "d"), SCHEMAS["model_description"], ("model_id",))
    first = registry.resolve_model_id(described, table.read(spark))
    row = first.first()
    assert row["model_id"] == 1 and row["date_time"] == datetime(2023, 3, 1, 5)
    text = json.loads(row["description"])
    assert text["model_formula"] == ["~", "q_kfz", "x + y"]
    assert text["dates"] == {"train_start": "2023-01-01 00:00:00", "train_end": "2023-03-01 05:00:00"}
    assert text["hyperparams"]["max_depth"] == 9 and "reg_lambda" not in text["hyperparams"]
    tb.upsert_latest(first, table)
    tb.upsert_latest(first.withColumn("model_id", F.lit(7).cast("bigint")).withColumn("model_name", F.lit("n")), table)
    assert registry.resolve_model_id(described, table.read(spark)).first()["model_id"] == 1
    other = registry.describe_model(train, spec, best_params("v_kfz"), "m")
    assert registry.resolve_model_id(other, table.read(spark)).first()["model_id"] == 8
    several = described.unionByName(other).unionByName(other.withColumn("model_name", F.lit("z")))
    several = several.unionByName(other)
    ids = registry.resolve_model_id(several, table.read(spark)).collect()
    assert sorted(r["model_id"] for r in ids) == [1, 8, 8, 9]


@pytest.mark.parametrize("by", [(), ("x",)])
def test_a_rewrite_that_breaks_off_leaves_the_table(spark, tmp_path, by):
    table = tb.Table(str(tmp_path / "t"), SCHEMA, ("x", "y"), by)
    struct = table.struct
    good = spark.range(20).select(*[(F.col("id") + k).cast(f.dataType).alias(f.name) for k, f in enumerate(struct)])
    tb.upsert_latest(good, table)
    before = contents(spark, table)
    broken = good.withColumn("x", F.when(F.col("x") > 15, F.raise_error(F.lit("lost"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):
        tb._rewrite(broken, table)
    assert contents(spark, table) == before


def test_months_are_folders(spark, tmp_path):
    key = ("model_id", "date_time", "x", "y")
    table = tb.Table(str(tmp_path / "p"), SCHEMAS["predictions"], key, ("model_id", "month"), month_of="date_time")
    rows = [(1, datetime(2024, m, 1), 0, 0, float(m)) for m in (1, 2, 3)]
    tb.upsert_latest(spark.createDataFrame(rows, table.struct), table)
    tb.upsert_latest(spark.createDataFrame([(1, datetime(2024, 2, 1), 0, 0, 9.0)], table.struct), table)
    assert sorted(r["value"] for r in table.read(spark).collect()) == [1.0, 3.0, 9.0]
    assert sorted(p.name for p in (tmp_path / "p" / "model_id=1").iterdir()) == ["month=202401", "month=202402", "month=202403"]
    with pytest.raises(ValueError):
        tb.Table("p", SCHEMAS["predictions"], key, ("month",))


def test_final_model_pointer(spark, tmp_path):
    table = tb.Table(str(tmp_path / "f"), SCHEMAS["final_models"], ("depvar",))
    for model_id in (3, 5):
        registry.set_final_model(spark, table, "q_kfz", model_id)
    registry.set_final_model(spark, table, "v_kfz", 4, dry_run=True)
    assert contents(spark, table) == [("q_kfz", 5)]


def test_repeated_rows_do_not_cover_gaps(spark):
    """Two cells with as many rows as hours: one has an hour twice and another not at all."""
    hours = [datetime(2024, 3, 30, 20) + timedelta(hours=k) for k in range(40)]
    rows = [(h, 1, 1) for h in hours] + [(h, 2, 1) for h in hours if h != hours[33]] + [(hours[0], 2, 1)]
    rows += [(hours[0] - timedelta(hours=1), 1, 1), (hours[0], 9, 9), (None, 1, 1)]
    stored = spark.createDataFrame(rows, "date_time timestamp_ntz, x bigint, y bigint")
    cells = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (3, 1)], "x bigint, y bigint")
    wanted = spark.createDataFrame([(h,) for h in [*hours, hours[0]]], "date_time timestamp_ntz")
    found = tb.hour_coverage(stored, cells, wanted)
    got = {(r["x"], r["y"]): tuple(r)[3:] for r in found.collect()}
    assert got == {(1, 1): (40, 0, None), (2, 1): (39, 1, hours[33]), (3, 1): (0, 40, hours[0])}
    assert not tb.covered(found).first()["all_preds_arrived"]
    whole = tb.covered(tb.hour_coverage(stored, cells.filter("x = 1"), wanted)).first()
    assert whole["all_preds_arrived"] and whole["cells"] == 1 and whole["n_missing"] == 0
    assert tb.covered(tb.hour_coverage(stored, cells, wanted.limit(0))).first()["all_preds_arrived"]
    assert tb.hour_coverage(stored, cells.limit(0), wanted).count() == 0


def test_first_gaps_at_any_place(spark):
    """Against a plain search, in hours that leave out words: before, inside, between and after the words a cell has."""
    start = datetime(1969, 12, 25, 5)
    hours = [start + timedelta(hours=k) for k in [*range(0, 100), *range(230, 300), 640, 641, 1000]]
    n = len(hours)
    missing = {0: [], 1: [0], 2: [n - 1], 3: range(n), 4: range(0, 60), 5: [50], 6: range(40, n), 7: range(1, n), 8: range(100, 170)}
    missing |= {9: [170, 171], 10: [*range(30, 75), 99], 11: range(0, n - 1), 12: [*range(75, 170), n - 1], 13: [3, 160]}
    rows = [(h, c, 0) for c, gone in missing.items() for k, h in enumerate(hours) if k not in gone]
    stored = spark.createDataFrame(rows, "date_time timestamp_ntz, x bigint, y bigint")
    cells = spark.createDataFrame([(c, 0) for c in missing], "x bigint, y bigint")
    wanted = spark.createDataFrame([(h,) for h in [None, *hours]], "date_time timestamp_ntz")
    got = {r["x"]: (r["n_hours"], r["n_missing"], r["first_missing"]) for r in tb.hour_coverage(stored, cells, wanted).collect()}
    assert got == {c: (n - len(g), len(g), hours[min(g)] if len(g) else None) for c, g in missing.items()}


def test_a_gap_is_not_looked_up_word_by_word(spark):
    """A look-up in a map walks through it, so the work of a cell would grow with the square of its words."""
    stored = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS date_time, 1L AS x, 1L AS y")
    plan = tb.hour_coverage(stored, stored, stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "map" not in plan.lower()
