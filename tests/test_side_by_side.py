"""Fits that share rows and run side by side, Shapley values over groups of trees, and slices of ranks."""

import threading
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from sensorgrid import session
from sensorgrid.operators import boosting as bo
from sensorgrid.operators import evaluate, explain
from sensorgrid.operators.model import BoostParams, FeatureSpec
from sensorgrid.session import side_by_side

SPEC = FeatureSpec("t", ("a", "b", "c"))


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.random((1500, 3)), columns=list("abc"))
    pdf["t"] = 20 * (pdf.a > 0.5) + 10 * pdf.b + rng.normal(0, 1, 1500)
    pdf["id"] = range(1500)
    frame = spark.createDataFrame(pdf)
    for k in (1, 2):
        name = F.when(F.col("id") % 3 == k, "test").when(F.col("id") % 3 == 0, "train").otherwise("unused")
        frame = frame.withColumn(f"fold_{k}", name)
    return frame.repartition(3, "id").cache()


def puts(monkeypatch):
    """Columns of every table that a bucketed stage is given."""
    seen, real = [], session.BucketedStage.put
    monkeypatch.setattr(session.BucketedStage, "put", lambda self, df: (seen.append(sorted(df.columns)), real(self, df))[1])
    return seen


def test_vectors_are_written_once_in_thirty_rounds(spark, data, monkeypatch):
    seen = puts(monkeypatch)
    bo.fit_boosted(data, SPEC, BoostParams(30, 1, eta=0.3, reg_lambda=1.0))
    assert [c for c in seen if "_features" in c] == [["_features", "_id", "_row", "t"]]
    assert seen.count(["_id", "_pred"]) == 2 and len(seen) == 3
    params = BoostParams(6, 2, eta=0.3, reg_lambda=1.0)
    model, at_once = (bo.fit_boosted(data, SPEC, params, stage_every=n) for n in (2, 1000))
    for a, b in zip(model.nodes, at_once.nodes, strict=True):
        assert (a.feature, a.threshold, a.left, a.right) == (b.feature, b.threshold, b.left, b.right)
        assert a.weight == pytest.approx(b.weight, abs=1e-9)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("train")]


def test_rows_and_predictions_meet_without_a_shuffle(data):
    rows = bo._Rows(bo.assembled(data, SPEC), "rows")
    running = bo._Running(rows.part(F.col("t") > 0), "t", "rows", 1.0)
    predictions = running.stage.put(running.frame.select("_id", "_pred"))
    joined = running.rows.join(predictions.hint("shuffle_hash"), "_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Exchange" not in plan
    assert joined.count() == data.filter("t > 0").count()
    ids = rows.frame.select("_id").distinct().count()
    running.clear()
    rows.clear()
    assert ids == data.count()


def test_nodes_read_from_the_model_add_up(data):
    """Reads what Spark keeps in a fitted tree; of Spark 4.1."""
    import pyspark

    assert pyspark.__version__.startswith("4.1"), "look at _grown_nodes again"
    frame = bo.assembled(data, SPEC).withColumn("_pred", F.lit(0.0)).withColumn("_some_features", F.col("_features"))
    tree = bo._grow(frame, "t", BoostParams(1, 3, eta=1.0, reg_lambda=0.0), 0, 64)
    nodes = bo._grown_nodes(tree)
    assert nodes[0].count == data.count() and len(nodes) == tree.numNodes
    for n in nodes:
        if n.left >= 0:
            assert nodes[n.left].count + nodes[n.right].count == n.count
            assert nodes[n.left].total + nodes[n.right].total == pytest.approx(n.total)


def test_a_broken_off_search_goes_on(spark, data, monkeypatch, tmp_path):
    grid = spark.createDataFrame(
        [(k, 2, 2, 0.1 * k, 0.0, 1.0, 1, 1.0) for k in range(1, 4)],
        "trial bigint, nrounds int, max_depth int, eta double, gamma double, colsample_bytree double, "
        "min_child_weight int, subsample double",
    )
    folds, record = ["fold_1", "fold_2"], str(tmp_path / "record")
    plain = bo.search(data, SPEC, grid, folds, at_once=1).orderBy("trial").collect()
    real, calls = bo._fit, []

    def failing(*args, **kwargs):
        calls.append(kwargs["params"].eta)
        if len(calls) == 4:
            raise RuntimeError("broken off")
        return real(*args, **kwargs)

    monkeypatch.setattr(bo, "_fit", failing)
    with pytest.raises(RuntimeError, match="broken off"):
        bo.search(data, SPEC, grid, folds, record=record, at_once=1)
    assert len(calls) == 4
    found = bo.search(data, SPEC, grid, folds, record=record, at_once=2).orderBy("trial").collect()
    assert len(calls) == 4 + 3  # the fits that were not recorded
    assert found == plain
    assert bo.search(data, SPEC, grid, folds, record=record).orderBy("trial").collect() == plain and len(calls) == 7
    bo.search(data, SPEC, grid.limit(1), folds, record=record, seed=1)
    assert len(calls) == 9  # another seed is another fit


def test_tasks_run_side_by_side_and_errors_stop_them(spark):
    at_once, most, lock = 0, 0, threading.Lock()

    def task(k):
        nonlocal at_once, most
        with lock:
            at_once += 1
            most = max(most, at_once)
        time.sleep(0.2)
        with lock:
            at_once -= 1
        return spark.range(k).count()

    assert side_by_side(spark, [lambda k=k: task(k) for k in range(6)], 3) == list(range(6))
    assert most == 3
    done = []
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1 / 0, *[lambda k=k: done.append(k) or time.sleep(0.1) for k in range(20)]], 2)
    assert len(done) < 20


def test_contributions_over_groups_of_trees(data, monkeypatch):
    model = bo.fit_boosted(data, SPEC, BoostParams(5, 3, eta=0.5, reg_lambda=1.0))
    monkeypatch.setattr(explain, "BLOCK_ROWS", 700)
    by_rows = explain.shap_contributions(data, model, keep=["id"]).toPandas().sort_values("id", ignore_index=True)
    assert explain._tree_groups(1500, 5, 8) == 2 and explain._tree_groups(None, 5, 8) == 1
    by_both = explain.shap_contributions(data, model, keep=["id"], rows=1500).toPandas().sort_values("id", ignore_index=True)
    assert list(by_rows.columns) == list(by_both.columns)
    assert np.allclose(by_rows, by_both, atol=1e-9)


def test_ranks_of_skewed_values(spark):
    """Nearly all values within a millionth of the range, a third of the rows one value, and nulls."""
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.random(4000) * 1e-6, rng.random(40) * 1e9, np.full(2000, 5e-7), [-1e12]])
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = {r["v"]: r["rank"] for r in evaluate.average_ranks(frame, "v", slice_rows=50).collect()}
    ranks = pd.Series(values).rank()
    assert len(got) == len(set(values)) and all(got[v] == r for v, r in zip(values, ranks, strict=True))
    counts = frame.filter("v IS NOT NULL").groupBy("v").count()
    edges = evaluate._slice_edges(counts, "v", 50)
    sizes = counts.groupBy(evaluate.slice_of(F.col("v"), edges).alias("s")).count().collect()
    assert max(r["count"] for r in sizes) <= 50 and len(edges) >= len(set(values)) / 50
    assert len(evaluate._slice_edges(counts, "v", 10**6)) == 1
    assert evaluate.average_ranks(frame.limit(0), "v").count() == 0
