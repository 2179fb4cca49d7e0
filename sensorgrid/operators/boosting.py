"""Boosted regression trees with an L2 penalty, on Spark ML decision trees.

Spark grows each tree on the residuals. The stored node statistics (rows and residual sum) then
give penalised leaf weights, penalised gains, and the pruning of splits that gain too little. The
model is a table of nodes, bounded by rounds × 2^(depth + 1) whatever the data size.
"""

from __future__ import annotations

import hashlib
import json
import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.errors import AnalysisException
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sensorgrid.functions.expressions import non_negative
from sensorgrid.operators.evaluate import metric_columns
from sensorgrid.operators.model import LAMBDAS, BoostParams, FeatureSpec
from sensorgrid.schemas import require_columns
from sensorgrid.session import BucketedStage, plan_bytes, ship_package, side_by_side

NODE_SCHEMA = (
    "tree int, node int, feature string, threshold double, left int, right int, "
    "weight double, cover double, gain double"
)
MAX_BINS = 256
STAGE_EVERY = 10
EARLY_STOPPING_ROUNDS = 5
#: Fits of a search, a sweep or a validation that run at a time, and bytes of a bucket of their rows.
FITS_AT_ONCE = 4
_BUCKET_BYTES = 64 << 20


@dataclass(frozen=True)
class Node:
    """A split (rows with ``feature <= threshold`` go left) or, with ``feature`` None, a leaf."""

    tree: int
    node: int
    feature: str | None
    threshold: float | None
    left: int | None
    right: int | None
    weight: float
    cover: float
    gain: float | None


@dataclass
class BoostedModel:
    """``history`` has one (round, validation RMSE) per round if validation was on."""

    spec: FeatureSpec
    params: BoostParams
    base_score: float
    nodes: list[Node]
    best_round: int
    history: list[tuple] = field(default_factory=list)

    def node_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([Row(**asdict(n)) for n in self.nodes], NODE_SCHEMA)

    def trees(self) -> list[list[Node]]:
        grouped: dict[int, list[Node]] = {}
        for n in self.nodes:
            grouped.setdefault(n.tree, []).append(n)
        return [sorted(grouped[t], key=lambda n: n.node) for t in sorted(grouped)]


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric predictor columns as one vector column."""
    require_columns(df, features, "assemble")
    numbers = df.withColumns({f: F.col(f).cast("double") for f in features})
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(numbers)


# --- Fitting ----------------------------------------------------------------------------------
@dataclass
class _Grown:
    """A node of a grown tree: its rows, their residual sum, and its split."""

    count: float
    total: float
    feature: int = -1
    threshold: float = math.nan
    left: int = -1
    right: int = -1


def _grown_nodes(model) -> list[_Grown]:
    """Nodes of a fitted tree in pre-order, at most 2^(depth + 1), from the model itself."""
    nodes: list[_Grown] = []

    def visit(node) -> int:
        count, total = list(node.impurityStats().stats())[:2]
        number = len(nodes)
        nodes.append(_Grown(count, total))
        if node.subtreeDepth() > 0:
            own, split = nodes[number], node.split()
            own.feature, own.threshold = split.featureIndex(), split.threshold()
            own.left, own.right = visit(node.leftChild()), visit(node.rightChild())
        return number

    visit(model._java_obj.rootNode())
    return nodes


def _penalised_tree(grown: list[_Grown], tree: int, names: Sequence[str], params: BoostParams):
    """Nodes of one Spark tree with penalised weights, and the weight of each Spark leaf.

    A split whose both children are leaves is removed if its gain is below ``gamma``, from the
    bottom up.
    """

    def strength(node: _Grown) -> float:
        return node.total**2 / (node.count + params.reg_lambda)

    kept: dict[int, float] = {}  # number of a kept split: its gain
    for number in range(len(grown) - 1, -1, -1):  # children come after their parent
        node = grown[number]
        if node.left < 0:
            continue
        gain = strength(grown[node.left]) + strength(grown[node.right]) - strength(node)
        if gain >= params.gamma or node.left in kept or node.right in kept:
            kept[number] = gain

    nodes: list[Node] = []
    leaf_weights: list[float] = []

    def visit(of: int, pruned_weight: float | None) -> int:
        """Number the kept nodes in pre-order, which is also Spark's order of leaves."""
        node = grown[of]
        if pruned_weight is not None:
            if node.left < 0:
                leaf_weights.append(pruned_weight)
            else:
                visit(node.left, pruned_weight)
                visit(node.right, pruned_weight)
            return -1
        number, w = len(nodes), params.eta * node.total / (node.count + params.reg_lambda)
        nodes.append(Node(tree, number, None, None, None, None, w, node.count, None))
        if of in kept:
            left, right = visit(node.left, None), visit(node.right, None)
            feature = names[node.feature]
            nodes[number] = Node(tree, number, feature, node.threshold, left, right, w, node.count, kept[of])
        elif node.left < 0:
            leaf_weights.append(w)
        else:
            visit(node.left, w)
            visit(node.right, w)
        return number

    visit(0, None)
    return nodes, leaf_weights


def _add_tree(df: DataFrame, model, leaf_weights: Sequence[float]) -> DataFrame:
    """Move ``_pred`` by the weight of the row's leaf; stays in the JVM."""
    weights = F.array(*[F.lit(float(w)) for w in leaf_weights])
    moved = F.col("_pred") + F.element_at(weights, F.col("_leaf").cast("int") + 1)
    return (
        model.transform(df)
        .withColumn("_pred", moved)
        .drop("_leaf", "_tree_prediction", "_some_features")
    )


class _Rows:
    """The rows that fits read, written once, in enough pieces for all cores.

    Each row has an ``_id`` of its own, by which the rows and the running predictions of a fit are
    dealt alike, so that they meet without a shuffle.
    """

    def __init__(self, df: DataFrame, name: str):
        spark = df.sparkSession
        cores = spark.sparkContext.defaultParallelism
        # statistics of joins may be far too high
        self.buckets = max(cores, min(plan_bytes(df) // _BUCKET_BYTES, 16 * cores))
        self.stage = BucketedStage(spark, name, "_id", self.buckets)
        self.frame = self.stage.put(df.withColumn("_id", F.monotonically_increasing_id()))

    def part(self, condition: Column | None = None) -> _Part:
        return _Part(self.frame if condition is None else self.frame.filter(condition), self.buckets)

    def clear(self) -> None:
        self.stage.clear()


@dataclass
class _Part:
    """Some of the staged rows of several fits."""

    frame: DataFrame
    buckets: int


class _Running:
    """Rows of one fit with their prediction so far.

    The prediction is a table (``_id``, ``_pred``) beside the rows. Only this narrow table is
    written anew; between two writes the trees since then are added on the way.
    """

    def __init__(self, part: _Part, target: str, name: str, base_score: float):
        self.rows = part.frame.select("_id", "_row", "_features", target)
        self.stage = BucketedStage(part.frame.sparkSession, f"{name}-pred", "_id", part.buckets)
        self.frame = self.rows.withColumn("_pred", F.lit(float(base_score)))

    def add(self, slicer: VectorSlicer, tree, leaf_weights: Sequence[float], write: bool) -> None:
        moved = _add_tree(slicer.transform(self.frame), tree, leaf_weights)
        if write:
            predictions = self.stage.put(moved.select("_id", "_pred"))
            moved = self.rows.join(predictions.hint("shuffle_hash"), "_id")
        self.frame = moved

    def clear(self) -> None:
        self.stage.clear()


def _sampled(df: DataFrame, share: float, seed: int, round_no: int) -> DataFrame:
    """The rows of one round, by a hash of the row."""
    if share >= 1:
        return df
    unit = F.pmod(F.xxhash64("_row", F.lit(seed), F.lit(round_no)), F.lit(2**31)) / float(2**31)
    return df.filter(unit < share)


def _grow(df: DataFrame, target: str, params: BoostParams, seed: int, max_bins: int):
    """One Spark tree on what is left of the target."""
    return DecisionTreeRegressor(
        featuresCol="_some_features",
        labelCol="_residual",
        predictionCol="_tree_prediction",
        leafCol="_leaf",
        maxDepth=params.max_depth,
        maxBins=max_bins,
        minInstancesPerNode=max(1, int(params.min_child_weight)),
        seed=seed,
    ).fit(df.select("_some_features", (F.col(target) - F.col("_pred")).alias("_residual")))


def _rmse(df: DataFrame, target: str) -> float:
    error = non_negative("_pred") - F.col(target)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse")).first()["rmse"]


def assembled(
    df: DataFrame, spec: FeatureSpec, keep: Sequence[str] = (), row_key: Sequence[str] | None = None
) -> DataFrame:
    """What fits read of ``df``: a hash of the row, the predictors as a vector, the target, ``keep``."""
    require_columns(df, [spec.target, *spec.features, *keep], "assembled")
    keyed = df.withColumn("_row", F.xxhash64(*(row_key or [spec.target, *spec.features])))
    target = F.col(spec.target).cast("double").alias(spec.target)
    return assemble(keyed, spec.features, "_features").select("_row", "_features", target, *keep)


def fit_boosted(
    train: DataFrame,
    spec: FeatureSpec,
    params: BoostParams,
    validation: DataFrame | None = None,
    early_stopping_rounds: int = EARLY_STOPPING_ROUNDS,
    base_score: float | None = None,
    seed: int = 0,
    row_key: Sequence[str] | None = None,
    max_bins: int = MAX_BINS,
    stage_every: int = STAGE_EVERY,
) -> BoostedModel:
    """Fit trees one after the other to what is left of the target.

    ``validation`` turns on early stopping: fitting ends after ``early_stopping_rounds`` rounds
    without a lower validation RMSE, and later trees are dropped. ``base_score`` is the start value,
    by default the mean of the target. Row samples are drawn by a hash of ``row_key`` (by default
    of all features and the target), so a recomputed partition draws the same rows. Rows are written
    once; beside them the running prediction is written every ``stage_every`` rounds. Predictors with
    more than ``max_bins`` values are cut at quantiles, which Spark takes from a bounded sample.
    """
    given = {"train": train} | ({} if validation is None else {"watch": validation})
    staged = [_Rows(assembled(df, spec, row_key=row_key), name) for name, df in given.items()]
    try:
        return _fit(*[s.part() for s in staged], spec=spec, params=params, patience=early_stopping_rounds,
                    base_score=base_score, seed=seed, max_bins=max_bins, stage_every=stage_every)
    finally:
        for rows in staged:
            rows.clear()


def _fit(
    train: _Part,
    validation: _Part | None = None,
    *,
    spec: FeatureSpec,
    params: BoostParams,
    patience: int = EARLY_STOPPING_ROUNDS,
    base_score: float | None = None,
    seed: int = 0,
    max_bins: int = MAX_BINS,
    stage_every: int = STAGE_EVERY,
) -> BoostedModel:
    target = spec.target
    if base_score is None:
        base_score = train.frame.agg(F.avg(target).alias("m")).first()["m"]
    parts = {"train": train} | ({"validation": validation} if validation else {})
    running = {name: _Running(part, target, name, base_score) for name, part in parts.items()}
    draw = random.Random(seed)
    n_features = len(spec.features)
    n_drawn = max(1, round(params.colsample_bytree * n_features))
    nodes: list[Node] = []
    history: list[tuple] = []
    best_round, best_error = 0, math.inf
    try:
        for round_no in range(1, params.nrounds + 1):
            picked = sorted(draw.sample(range(n_features), n_drawn))
            slicer = VectorSlicer(inputCol="_features", outputCol="_some_features", indices=picked)
            rows = _sampled(running["train"].frame, params.subsample, seed, round_no)
            tree = _grow(slicer.transform(rows), target, params, seed + round_no, max_bins)
            names = [spec.features[i] for i in picked]
            tree_nodes, leaf_weights = _penalised_tree(_grown_nodes(tree), round_no, names, params)
            nodes += tree_nodes
            write = round_no % stage_every == 0 and round_no < params.nrounds
            for rows in running.values():
                rows.add(slicer, tree, leaf_weights, write)
            if validation is None:
                best_round = round_no
                continue
            error = _rmse(running["validation"].frame, target)
            history.append((round_no, error))
            if error < best_error:
                best_round, best_error = round_no, error
            elif round_no - best_round >= patience:
                break
    finally:
        for rows in running.values():
            rows.clear()
    nodes = [n for n in nodes if n.tree <= best_round]
    return BoostedModel(spec, params, float(base_score), nodes, best_round, history)


# --- Prediction -------------------------------------------------------------------------------
def _complete_trees(model: BoostedModel):
    """Trees as complete binary arrays: the children of slot i are 2i + 1 and 2i + 2.

    A leaf above the bottom passes its weight down to its left, behind thresholds that nothing
    exceeds, so that all rows take the same number of steps.
    """
    position = {f: i for i, f in enumerate(model.spec.features)}
    out = []
    for tree in model.trees():
        depths = [0] * len(tree)
        for n in tree:
            if n.feature is not None:
                depths[n.left] = depths[n.right] = depths[n.node] + 1
        depth = max(depths)
        feature = np.zeros(2**depth - 1 or 1, dtype=np.int64)
        threshold = np.full(2**depth - 1 or 1, np.inf)
        value = np.zeros(2**depth)

        def place(number: int, slot: int, level: int, tree=tree, depth=depth, f=feature, t=threshold, v=value):
            n = tree[number]
            if n.feature is None:
                v[((slot + 1) << (depth - level)) - 2**depth] = n.weight
                return
            f[slot], t[slot] = position[n.feature], n.threshold
            place(n.left, 2 * slot + 1, level + 1)
            place(n.right, 2 * slot + 2, level + 1)

        place(0, 0, 0)
        out.append((depth, feature, threshold, value))
    return out


def _score_batch(trees, base_score: float, x: np.ndarray) -> np.ndarray:
    """Sum of the leaf weights, one vector operation per tree level."""
    total = np.full(len(x), base_score)
    flat, start = x.ravel(), np.arange(len(x)) * x.shape[1]
    for depth, feature, threshold, value in trees:
        slot = np.zeros(len(x), dtype=np.int64)
        for _ in range(depth):
            slot = 2 * slot + 1 + (flat[start + feature[slot]] > threshold[slot])
        total += value[slot - (2**depth - 1)]
    return total


def prediction_column(
    model: BoostedModel, spark: SparkSession, bounded: bool = True, shared: Broadcast | None = None
) -> Column:
    """Prediction as a column. Only the predictors travel to Python, in Arrow batches; the node
    arrays are broadcast once, and their size is bounded by rounds and depth."""
    ship_package(spark)
    shared = shared or spark.sparkContext.broadcast(_complete_trees(model))
    base = model.base_score

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees = shared.value
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])
            yield pd.Series(_score_batch(trees, base, x))

    raw = score(*[F.col(f).cast("double") for f in model.spec.features])
    return non_negative(raw) if bounded else raw


def predict(
    df: DataFrame, model: BoostedModel, out: str = "pred", bounded: bool = True
) -> DataFrame:
    """Add the model's prediction, not below 0 unless ``bounded`` is False."""
    require_columns(df, model.spec.features, "predict")
    raw = df.withColumn(out, prediction_column(model, df.sparkSession, bounded=False))
    return raw.withColumn(out, non_negative(out)) if bounded else raw


# --- Storage ----------------------------------------------------------------------------------
def save_model(spark: SparkSession, model: BoostedModel, path: str) -> None:
    """Store the node table and, as one JSON row, everything else."""
    meta = {
        "target": model.spec.target,
        "features": list(model.spec.features),
        "params": asdict(model.params),
        "base_score": model.base_score,
        "best_round": model.best_round,
        "history": model.history,
    }
    model.node_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> BoostedModel:
    meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
    nodes = [Node(**r.asDict()) for r in spark.read.parquet(f"{path}/nodes").collect()]
    return BoostedModel(
        FeatureSpec(meta["target"], tuple(meta["features"])),
        BoostParams(**meta["params"]),
        meta["base_score"],
        sorted(nodes, key=lambda n: (n.tree, n.node)),
        meta["best_round"],
        [tuple(h) for h in meta["history"]],
    )


# --- Search and validation --------------------------------------------------------------------
TRIAL_SCHEMA = (
    "trial bigint, nrounds int, max_depth int, eta double, gamma double, colsample_bytree double, "
    "min_child_weight int, subsample double, rmse double, r2_corr double, mae double"
)


def _metrics(rows: DataFrame, model: BoostedModel) -> dict:
    """Errors on staged rows; the model is taken off the cluster afterwards."""
    spark = rows.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(_complete_trees(model))
    base, target = model.base_score, model.spec.target

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            x = np.array(vectors.tolist(), dtype=np.float64).reshape(len(vectors), -1)
            yield pd.Series(_score_batch(shared.value, base, x))

    pred = non_negative(score(vector_to_array("_features"))).alias("pred")
    found = rows.select(target, pred).agg(*metric_columns(target, "pred")).first()
    shared.destroy()
    return found.asDict()


_RECORD_SCHEMA = "fit string, trial bigint, fold string, metrics string"


def _recorded(spark: SparkSession, path: str | None) -> dict[str, dict]:
    """Errors of the fits that a search has recorded in ``path``, in a folder for each fit."""
    if path is None:
        return {}
    try:
        kept = spark.read.schema(_RECORD_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
        return {r["fit"]: json.loads(r["metrics"]) for r in kept.collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


def search(
    df: DataFrame,
    spec: FeatureSpec,
    grid: DataFrame,
    folds: Sequence[str],
    validation: DataFrame | None = None,
    seed: int = 0,
    record: str | None = None,
    at_once: int = FITS_AT_ONCE,
) -> DataFrame:
    """Fit every parameter row of ``grid`` on every fold column of ``df``; means over the folds.

    A fold column holds "train", "test" or "unused". ``at_once`` fits run side by side, each spread
    over the cluster. ``validation`` is the watch data for early stopping. Both are assembled and
    written once for all fits, and errors are measured on the written rows. With ``record``, a
    folder in the shared store, each fit's errors are kept as soon as they are known, and a search
    that is run again makes only the fits that are not there: those of other parameters, another
    seed or another fold.
    """
    spark = df.sparkSession
    trials = {row["trial"]: BoostParams.from_row(row) for row in grid.orderBy("trial").collect()}
    known = _recorded(spark, record)

    def name(trial: int, fold: str) -> str:
        return json.dumps([trial, fold, seed, spec.target, list(spec.features), asdict(trials[trial])])

    open_fits = [(t, f) for t in trials for f in folds if name(t, f) not in known]
    staged = []
    try:
        if open_fits:
            staged = [_Rows(assembled(df, spec, keep=folds), "search")]
            if validation is not None:
                staged.append(_Rows(assembled(validation, spec), "watch"))

        def fit(trial: int, fold: str) -> None:
            rows, watch = staged[0], [s.part() for s in staged[1:]]
            model = _fit(rows.part(F.col(fold) == "train"), *watch, spec=spec, params=trials[trial], seed=seed)
            measured = _metrics(rows.frame.filter(F.col(fold) == "test"), model)
            known[name(trial, fold)] = measured
            if record is not None:
                row = [(name(trial, fold), trial, fold, json.dumps(measured))]
                # writers of one folder would clear each other's unfinished files
                own = f"{record}/fit-{hashlib.sha1(name(trial, fold).encode()).hexdigest()}"
                spark.createDataFrame(row, _RECORD_SCHEMA).coalesce(1).write.mode("overwrite").parquet(own)

        side_by_side(spark, [partial(fit, *each) for each in open_fits], at_once)
    finally:
        for rows in staged:
            rows.clear()
    results = []
    for trial, params in trials.items():
        measured = [known[name(trial, fold)] for fold in folds]
        means = [
            float(np.mean([m[k] if m[k] is not None else math.nan for m in measured]))
            for k in ("rmse", "r2_corr", "mae")
        ]
        results.append((trial, *params.grid_values().values(), *means))
    return spark.createDataFrame(results, TRIAL_SCHEMA)


def search_results(best: DataFrame, results: DataFrame) -> DataFrame:
    """Metrics of a parameter row, best first: left join on all columns that both sides have."""
    common = [c for c in best.columns if c in results.columns]
    found = best.join(results, common, "left")
    order = [F.col(c).asc_nulls_last() for c in ("rmse", "trial") if c in found.columns]
    return found.orderBy(*order) if order else found


def best_trial(results: DataFrame, by: str = "rmse", tie: str = "trial") -> DataFrame:
    """The row with the smallest error."""
    return results.orderBy(F.col(by).asc_nulls_last(), tie).limit(1)


SWEEP_SCHEMA = (
    "lambda double, rmse_is double, rmse_oos double, r2_is double, r2_oos double, "
    "mae_is double, mae_oos double"
)


def lambda_sweep(
    train: DataFrame,
    test: DataFrame,
    spec: FeatureSpec,
    params: BoostParams,
    lambdas: Sequence[float] = LAMBDAS,
    watch: DataFrame | None = None,
    seed: int = 0,
    at_once: int = FITS_AT_ONCE,
) -> DataFrame:
    """Errors in and out of sample for each penalty; pick with ``best_trial(…, "rmse_oos")``.

    Early stopping watches ``watch``, by default the test data. Then the out-of-sample errors are
    measured on data that also chose the number of rounds; pass a third split to avoid that.
    """
    watched = test if watch is None else watch
    frames = {"train": train, "test": test} | ({} if watch is None else {"watch": watched})
    staged = {}
    try:
        for name, df in frames.items():
            staged[name] = _Rows(assembled(df, spec), f"sweep-{name}")

        def fit(value: float) -> tuple:
            parts = staged["train"].part(), staged["watch" if "watch" in staged else "test"].part()
            model = _fit(*parts, spec=spec, params=params.with_(reg_lambda=float(value)), seed=seed)
            inside, outside = (_metrics(staged[name].frame, model) for name in ("train", "test"))
            return (float(value), *[m[k] for k in ("rmse", "r2", "mae") for m in (inside, outside)])

        rows = side_by_side(train.sparkSession, [partial(fit, value) for value in lambdas], at_once)
    finally:
        for each in staged.values():
            each.clear()
    return train.sparkSession.createDataFrame(rows, SWEEP_SCHEMA)


def spatial_cv(
    df: DataFrame,
    spec: FeatureSpec,
    params: BoostParams,
    folds: Sequence[int],
    fold: str = "fold",
    seed: int = 0,
    at_once: int = FITS_AT_ONCE,
) -> DataFrame:
    """Predict every row with a model that has not seen its fold; one table of all folds."""
    staged = _Rows(assembled(df, spec, keep=[fold]), "spatial")

    def fit(i: int) -> DataFrame:
        model = _fit(staged.part(F.col(fold) != i), spec=spec, params=params, seed=seed)
        return predict(df.filter(F.col(fold) == i), model)

    try:
        parts = side_by_side(df.sparkSession, [partial(fit, i) for i in folds], at_once)
    finally:
        staged.clear()
    return reduce(DataFrame.unionByName, parts)
