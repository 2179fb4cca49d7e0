"""Feature importance and Shapley contributions of a fitted model, as tables."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgrid.functions.expressions import feature_group
from sensorgrid.operators.boosting import BoostedModel, Node
from sensorgrid.operators.evaluate import bin_index
from sensorgrid.schemas import require_columns
from sensorgrid.session import cut_lineage, ship_package

# --- Fixed values -----------------------------------------------------------------------------
TOP_FEATURES = 10
TOP_EFFECTS = 6
EFFECT_BINS = 30
# ----------------------------------------------------------------------------------------------


def feature_importance(nodes: DataFrame, r2: float = 1.0, top: int | None = None) -> DataFrame:
    """Share of the total gain per feature, and that share times the model's R²."""
    splits = nodes.filter(F.col("feature").isNotNull())
    total = splits.agg(F.sum("gain").alias("total")).scalar()
    out = (
        splits.groupBy("feature")
        .agg((F.sum("gain") / total).alias("importance"))
        .withColumn("rel_importance", F.col("importance") * r2)
    )
    return out.orderBy(F.col("importance").desc(), "feature").limit(top) if top else out


def importance_by_group(importance: DataFrame, sort: bool = True) -> DataFrame:
    """Importance per group of features, in percent."""
    out = importance.groupBy(feature_group("feature").alias("feature_group")).agg(
        (100 * F.sum("importance")).alias("imp")
    )
    return out.orderBy(F.col("imp").desc()) if sort else out


#: Rows that a task explains at a time: as many as an Arrow batch holds by default.
BLOCK_ROWS = 10_000


# --- Shapley values ---------------------------------------------------------------------------
def expected_value(tree: list[Node]) -> float:
    """Mean leaf weight, weighted with the rows in each leaf."""
    leaves = [n for n in tree if n.feature is None]
    return sum(n.weight * n.cover for n in leaves) / tree[0].cover


def _tree_contributions(
    tree: list[Node], position: dict[str, int], x: np.ndarray, out: np.ndarray
) -> None:
    """Add one tree's exact path-dependent Shapley values of the rows ``x`` (features × rows) to
    ``out``.

    With z_j the share of training rows that follow a leaf's path in its tests of feature j,
    o_j = 1 if a row follows them and w the leaf's weight, feature i is worth
    w (o_i − z_i) ∫₀¹ Π_{j≠i} (z_j (1 − t) + o_j t) dt. The integrand is a polynomial in t, and a
    Gauss–Legendre rule with enough points gives the integral exactly.

    On the way down each row carries a bit o_j per tested feature, and the products of the formula
    are kept per bit pattern, not per row; a leaf looks its rows' patterns up.
    """
    depths = [0] * len(tree)
    for n in tree:
        if n.feature is not None:
            depths[n.left] = depths[n.right] = depths[n.node] + 1
    points, weights = np.polynomial.legendre.leggauss(max(1, (max(depths) + 1) // 2))
    t, omega = (points + 1) / 2, weights / 2
    rest = 1 - t

    def extended(product: np.ndarray | None, z: float) -> np.ndarray | None:
        """Products with one more feature as the highest bit; given up beyond one per row."""
        if product is None or 2 * len(product) > x.shape[1]:
            return None
        return np.concatenate((product * (z * rest), product * (z * rest + t)))

    def replaced(product: np.ndarray | None, bit: int, old: float, new: float) -> np.ndarray | None:
        """Products after a further test of a feature has changed its share."""
        if product is None:
            return None
        ratio = np.stack((np.full(len(t), new / old), (new * rest + t) / (old * rest + t)))
        return (product.reshape(-1, 2, bit, len(t)) * ratio[:, None, :]).reshape(-1, len(t))

    def leaf(weight: float, follows: np.ndarray, shares: dict[int, float], product) -> None:
        z = np.array([*shares.values()])
        off = np.outer(z, rest)
        on = off + t
        index = follows & (2 ** len(z) - 1)
        if product is None:  # more patterns than rows: only those that occur
            patterns, index = np.unique(index, return_inverse=True)
            bits = (patterns[:, None] >> np.arange(len(z))) & 1 == 1
            product = np.prod(np.where(bits[:, :, None], on, off), axis=1)
        else:
            bits = _bits(len(z))
        values = np.where(
            bits.T, ((1 - z) * (omega / on).T).T @ product.T, (-z * (omega / off).T).T @ product.T
        )
        for f, column in zip(shares, values * weight, strict=True):
            out[f] += column[index]

    def visit(n: Node, follows: np.ndarray, shares: dict[int, float], product) -> None:
        if n.feature is None:
            if shares:
                leaf(n.weight, follows, shares, product)
            return
        f = position[n.feature]
        seen = f in shares
        bit = 1 << (list(shares).index(f) if seen else len(shares))
        left = (x[f] <= n.threshold) * bit
        for child, misses in ((tree[n.left], bit - left), (tree[n.right], left)):
            old = shares.get(f, 1.0)
            z = old * child.cover / n.cover
            below = replaced(product, bit, old, z) if seen else extended(product, z)
            visit(child, follows & ~misses, {**shares, f: z}, below)

    visit(tree[0], np.full(x.shape[1], -1, dtype=np.intp), {}, np.ones((1, len(t))))


@cache
def _bits(m: int) -> np.ndarray:
    return (np.arange(2**m)[:, None] >> np.arange(m)) & 1 == 1


def contribution_column(model: BoostedModel, spark):
    """Struct with one value per feature and ``bias``; they add up to the unbounded prediction."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model.trees())
    names = list(model.spec.features)
    bias = model.base_score + sum(expected_value(t) for t in model.trees())

    @F.pandas_udf(", ".join(f"`{n}` double" for n in [*names, "bias"]))
    def contributions(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        trees, position = shared.value, {n: i for i, n in enumerate(names)}
        for columns in batches:
            x = np.vstack([c.to_numpy(dtype=np.float64) for c in columns])
            out = np.zeros(x.shape)
            for tree in trees:
                _tree_contributions(tree, position, x, out)
            yield pd.DataFrame(out.T, columns=names).assign(bias=bias)

    return contributions(*[F.col(n).cast("double") for n in names])


def _tree_groups(rows: int | None, trees: int, cores: int) -> int:
    """Into how many groups the trees are split so that all cores have work in whole blocks of rows."""
    blocks = max(1, -(-rows // BLOCK_ROWS)) if rows is not None else cores
    return max(1, min(trees, cores // blocks))


def _by_tree_groups(rows: DataFrame, model: BoostedModel, groups: int, blocks: int) -> DataFrame:
    """(_id, _c): contributions of rows ``_id``, ``_x``, in cells of a block of rows and a group of trees.

    A leaf costs a task the same whether it has a thousand rows or ten thousand, so few rows are
    better spread by trees than by rows. Each cell is one task, and its sums are added by row.
    """
    spark, names = rows.sparkSession, list(model.spec.features)
    ship_package(spark)
    trees = model.trees()
    # a task unpacks the trees of its own group only
    shared = spark.sparkContext.broadcast([pickle.dumps(trees[g::groups]) for g in range(groups)])
    position = {n: i for i, n in enumerate(names)}

    def contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list = []
        for batch in batches:
            own = own or pickle.loads(shared.value[batch.column("_group")[0].as_py()])
            x = batch.column("_x").flatten().to_numpy().reshape(len(batch), -1).T.copy()
            out = np.zeros(x.shape)
            for tree in own:
                _tree_contributions(tree, position, x, out)
            sums = pa.FixedSizeListArray.from_arrays(pa.array(out.T.ravel()), len(names)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), sums], ["_id", "_c"])

    cells = rows.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    at = F.col("_group") + groups * F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int")
    dealt = cells.repartitionById(groups * blocks, at)
    parts = dealt.mapInArrow(contributions, "_id bigint, _c array<double>")
    return parts.groupBy("_id").agg(*[F.sum(F.col("_c")[i]).alias(f"_{i}") for i in range(len(names))])


def shap_contributions(
    df: DataFrame, model: BoostedModel, keep: Sequence[str] = (), prefix: str = "shap_", rows: int | None = None
) -> DataFrame:
    """Shapley contribution of every feature for every row, with the bias.

    Keeps the columns ``keep`` and the features. Sample the rows first if a sample is enough.
    ``rows``, the number of rows if that is known to be small, lets the work be spread over groups
    of trees as well; the rows are then staged. Without it the work is spread by rows alone.
    """
    names = list(model.spec.features)
    require_columns(df, names, "shap_contributions")
    kept = [*keep, *[n for n in names if n not in keep]]
    trees = model.trees()
    groups = _tree_groups(rows, len(trees), df.sparkSession.sparkContext.defaultParallelism)
    if groups == 1:
        explained = df.select(*kept, contribution_column(model, df.sparkSession).alias("_c"))
        return explained.select(*kept, *[F.col("_c")[n].alias(prefix + n) for n in [*names, "bias"]])
    staged = cut_lineage(df.select(*kept).withColumn("_id", F.monotonically_increasing_id()))
    x = F.array(*[F.coalesce(F.col(n).cast("double"), F.lit(math.nan)) for n in names]).alias("_x")
    blocks = max(1, -(-rows // BLOCK_ROWS))
    parts = _by_tree_groups(staged.select("_id", x), model, groups, blocks)
    bias = model.base_score + sum(expected_value(t) for t in trees)
    return staged.join(parts, "_id").select(
        *kept, *[F.col(f"_{i}").alias(prefix + n) for i, n in enumerate(names)], F.lit(bias).alias(f"{prefix}bias")
    )


def _long(explained: DataFrame, features: Sequence[str], prefix: str) -> DataFrame:
    """One row per (row, feature): feature, its value, its contribution."""
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f).cast("double").alias("value"),
            F.col(prefix + f).alias("contribution"),
        )
        for f in features
    ]
    return explained.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def top_effects(
    explained: DataFrame, features: Sequence[str], top: int = TOP_EFFECTS, prefix: str = "shap_"
) -> list[str]:
    """The ``top`` features by mean absolute contribution; one row comes to the driver."""
    means = explained.agg(*[F.avg(F.abs(prefix + f)).alias(f) for f in features]).first()
    return sorted(features, key=lambda f: (-(means[f] or 0.0), f))[:top]


def shap_effects(
    explained: DataFrame,
    features: Sequence[str],
    bins: int = EFFECT_BINS,
    prefix: str = "shap_",
) -> DataFrame:
    """Mean contribution over the range of each feature: the table behind an effect plot.

    Pass ``top_effects(…)`` as ``features`` for the strongest ones only.
    """
    limits = explained.agg(
        *[
            F.struct(F.min(f).cast("double").alias("low"), F.max(f).cast("double").alias("high")).alias(f)
            for f in features
        ]
    )
    limits = limits.select(
        F.explode(
            F.array(*[F.struct(F.lit(f).alias("feature"), f"{f}.low", f"{f}.high") for f in features])
        ).alias("l")
    ).select("l.*")
    values = _long(explained, features, prefix).join(F.broadcast(limits), "feature")  # a row each
    return (
        values.withColumn("bin", bin_index(F.col("value"), F.col("low"), F.col("high"), bins))
        .groupBy("feature", "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("value").alias("mean_value"),
            F.avg("contribution").alias("mean_contribution"),
        )
    )
