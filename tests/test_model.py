import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorgrid.operators import boosting as bo
from sensorgrid.operators import explain
from sensorgrid.operators.boosting import BoostedModel, Node
from sensorgrid.operators.model import (
    PREDICTORS, BoostParams, FeatureSpec, best_params, feature_spec, random_grid,
)

SPEC = FeatureSpec("t", ("a", "b", "c"))


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.random((3000, 3)), columns=list("abc"))
    pdf["t"] = 20 * (pdf.a > 0.5) + 10 * pdf.b + rng.normal(0, 1, 3000)
    pdf["id"] = range(3000)
    return spark.createDataFrame(pdf).repartition(4, "id").cache()


@pytest.fixture(scope="module")
def fitted(data):
    return bo.fit_boosted(
        data.filter("id < 2400"), SPEC, BoostParams(4, 3, eta=0.5, reg_lambda=1.0),
        data.filter("id >= 2400"), stage_every=2,
    )


def test_configuration(spark):
    assert len(PREDICTORS) == 26 and feature_spec("q_kfz").features == feature_spec("v_kfz").features
    assert best_params("q_kfz").reg_lambda == 500000 and best_params("v_kfz").nrounds == 117
    for call in (feature_spec, best_params):
        with pytest.raises(ValueError):
            call("speed")
    grid = random_grid(spark, 200, seed=1).toPandas()
    assert len(grid) == 200 and grid.equals(random_grid(spark, 200, seed=1).toPandas())
    assert set(grid.max_depth) == {7, 8, 9, 10} and set(grid.min_child_weight) == set(range(21))
    assert grid.eta.between(0.001, 0.6).all() and grid.subsample.between(0.7, 1).all()
    assert grid.nrounds.eq(500).all() and abs(grid.gamma.mean() - 5) < 1


def test_errors_fall_and_predictions_are_close(data, fitted):
    errors = [e for _, e in fitted.history]
    assert len(errors) == 4 and errors == sorted(errors, reverse=True) and errors[-1] < 2.5
    row = bo.predict(data, fitted).agg(*bo.metric_columns("t", "pred")).first()
    assert row["r2"] > 0.95
    assert bo.predict(data, fitted).filter("pred < 0").isEmpty()


def test_training_prediction_equals_stored_trees(data):
    """Leaf lookups while fitting and the stored node arrays give the same numbers."""
    train = data.filter("id < 2400")
    model = bo.fit_boosted(train, SPEC, BoostParams(3, 3, eta=0.5, gamma=50.0, reg_lambda=2.0), train)
    row = bo.predict(train, model).agg(*bo.metric_columns("t", "pred")).first()
    assert row["rmse"] == pytest.approx(model.history[-1][1], rel=1e-9)


def test_leaf_weights_and_gains_follow_the_penalty(data):
    params = BoostParams(1, 2, eta=0.5, reg_lambda=300.0)
    model = bo.fit_boosted(data, SPEC, params)
    pdf = data.toPandas()
    residual = pdf.t - model.base_score
    tree = model.trees()[0]

    def check(node, rows):
        total, n = residual[rows].sum(), rows.sum()
        assert node.cover == n and node.weight == pytest.approx(0.5 * total / (n + 300))
        if node.feature is None:
            return total**2 / (n + 300)
        goes = pdf[node.feature] <= node.threshold
        left, right = (check(tree[c], rows & g) for c, g in ((node.left, goes), (node.right, ~goes)))
        parts = [residual[rows & g].sum() ** 2 / ((rows & g).sum() + 300) for g in (goes, ~goes)]
        assert node.gain == pytest.approx(sum(parts) - total**2 / (n + 300))
        return left, right

    check(tree[0], pd.Series(True, index=pdf.index))


def test_gamma_prunes_and_penalty_shrinks(data):
    plain = bo.fit_boosted(data, SPEC, BoostParams(1, 4))
    pruned = bo.fit_boosted(data, SPEC, BoostParams(1, 4, gamma=500.0))
    assert len(pruned.nodes) < len(plain.nodes)
    for n in pruned.nodes:
        if n.feature is not None:
            children = [pruned.nodes[n.left], pruned.nodes[n.right]]
            assert n.gain >= 500 or any(c.feature is not None for c in children)
    heavy = bo.fit_boosted(data, SPEC, BoostParams(1, 4, reg_lambda=1e6))
    assert max(abs(n.weight) for n in heavy.nodes) < max(abs(n.weight) for n in plain.nodes) / 50
    assert {n.feature for n in bo.fit_boosted(data, SPEC, BoostParams(1, 2, gamma=1e9)).nodes} == {None}


def test_sampling_is_repeatable(data):
    params = BoostParams(2, 2, colsample_bytree=0.67, subsample=0.8)
    first = bo.fit_boosted(data, SPEC, params, seed=5)
    again = bo.fit_boosted(data.repartition(3), SPEC, params, seed=5, row_key=["id"])
    third = bo.fit_boosted(data, SPEC, params, seed=5)
    assert [(n.feature, n.threshold) for n in first.nodes] == [(n.feature, n.threshold) for n in third.nodes]
    assert all(0.75 < t[0].cover / 3000 < 0.85 for m in (first, again) for t in m.trees())
    assert all(len({n.feature for n in t} - {None}) <= 2 for t in first.trees())


def test_early_stopping_drops_later_trees(data, spark):
    noise = data.withColumn("t", F.rand(3) * 10)
    model = bo.fit_boosted(
        noise.filter("id < 2400"), SPEC, BoostParams(12, 6, eta=0.9), noise.filter("id >= 2400"),
        early_stopping_rounds=2,
    )
    assert len(model.history) < 12
    assert model.best_round == min(model.history, key=lambda h: h[1])[0]
    assert max(n.tree for n in model.nodes) == model.best_round


def test_save_and_load(spark, data, fitted, tmp_path):
    bo.save_model(spark, fitted, str(tmp_path / "m"))
    loaded = bo.load_model(spark, str(tmp_path / "m"))
    assert loaded == fitted
    assert loaded.node_frame(spark).count() == len(fitted.nodes)


def test_search_sweep_and_spatial_folds(spark, data):
    folded = data.withColumn("fold_1", F.when(F.col("id") < 2000, "train").otherwise("test"))
    grid = random_grid(spark, 2).withColumns({"nrounds": F.lit(2), "max_depth": F.lit(2)})
    trials = bo.search(folded, SPEC, grid, ["fold_1"])
    assert trials.count() == 2
    best = bo.best_trial(trials)
    assert best.first()["rmse"] == trials.agg(F.min("rmse")).first()[0]
    assert bo.search_results(best.select("trial", "eta"), trials).count() == 1
    params = BoostParams.from_row(best.first())
    assert params.nrounds == 2 and params.reg_lambda == 1.0
    sweep = bo.lambda_sweep(
        data.filter("id < 2000"), data.filter("id >= 2000"), SPEC, BoostParams(2, 2, eta=0.5), (5.0, 5e4)
    )
    got = {r["lambda"]: r for r in sweep.collect()}
    assert got[5.0]["rmse_oos"] < got[5e4]["rmse_oos"] and got[5.0]["r2_is"] > 0
    assert bo.best_trial(sweep, "rmse_oos", "lambda").first()["lambda"] == 5.0
    folds = data.withColumn("fold", (F.col("id") % 2).cast("int"))
    out = bo.spatial_cv(folds, SPEC, BoostParams(1, 2), [0, 1])
    assert out.count() == 3000 and out.filter("pred IS NULL").isEmpty()


# --- Explanation ------------------------------------------------------------------------------
FEATURES = ("a", "b", "c", "d")


def random_tree(rng, tree, depth):
    nodes = []

    def grow(level, cover):
        number = len(nodes)
        nodes.append(None)
        if level == 0 or cover < 4 or rng.random() < 0.15:
            nodes[number] = Node(tree, number, None, None, None, None, rng.gauss(0, 1), cover, None)
            return number
        feature, threshold, part = rng.choice(FEATURES), rng.random(), rng.randint(1, cover - 1)
        left = grow(level - 1, part)
        right = grow(level - 1, cover - part)
        nodes[number] = Node(tree, number, feature, threshold, left, right, 0.0, cover, 1.0)
        return number

    grow(depth, 1000)
    return nodes


def brute_force(tree, row):
    """Shapley values by their definition, with path-dependent expectations."""

    def value(known, number=0):
        n = tree[number]
        if n.feature is None:
            return n.weight
        if n.feature in known:
            return value(known, n.left if row[n.feature] <= n.threshold else n.right)
        left, right = tree[n.left], tree[n.right]
        return (left.cover * value(known, n.left) + right.cover * value(known, n.right)) / n.cover

    out = {}
    for f in FEATURES:
        others = [g for g in FEATURES if g != f]
        out[f] = sum(
            math.factorial(k) * math.factorial(3 - k) / math.factorial(4)
            * (value({*s, f}) - value(set(s)))
            for k in range(4) for s in itertools.combinations(others, k)
        )
    return out


@pytest.mark.parametrize("depth, rows", [(1, 20), (3, 20), (6, 20), (6, 3)])
def test_contributions_match_the_definition(spark, depth, rows):
    rng = random.Random(depth)
    nodes = [*random_tree(rng, 1, depth), *random_tree(rng, 2, depth)]
    model = BoostedModel(FeatureSpec("t", FEATURES), BoostParams(2, depth), 3.0, nodes, 2)
    data = pd.DataFrame([[rng.random() for _ in FEATURES] for _ in range(rows)], columns=[*FEATURES])
    df = spark.createDataFrame(data).coalesce(1)
    predicted = bo.predict(df, model, bounded=False)
    got = explain.shap_contributions(predicted, model, keep=["pred"]).toPandas()
    for _, row in got.iterrows():
        parts = [brute_force(t, row) for t in model.trees()]
        for f in FEATURES:
            assert row[f"shap_{f}"] == pytest.approx(sum(p[f] for p in parts), abs=1e-9)
        total = row["shap_bias"] + sum(row[f"shap_{f}"] for f in FEATURES)
        assert total == pytest.approx(row["pred"])


def test_effects_and_importance(spark, data, fitted):
    importance = explain.feature_importance(fitted.node_frame(spark), r2=0.5, top=2)
    rows = importance.collect()
    assert [r["feature"] for r in rows] == ["a", "b"]
    assert rows[0]["rel_importance"] == rows[0]["importance"] / 2
    assert explain.importance_by_group(importance).first()["feature_group"] == "a"
    explained = explain.shap_contributions(data, fitted)
    strongest = explain.top_effects(explained, SPEC.features, top=2)
    assert strongest == ["a", "b"]
    effects = explain.shap_effects(explained, strongest, bins=4).toPandas()
    a = effects[effects.feature == "a"].sort_values("bin")
    assert a.n.sum() == 3000 and a.mean_contribution.iloc[0] < -5 < 5 < a.mean_contribution.iloc[-1]
