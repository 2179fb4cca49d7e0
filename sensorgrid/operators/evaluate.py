"""Error metrics, summaries per sensor, correlations and the tables behind plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.session import cut_lineage

# --- Fixed values -----------------------------------------------------------------------------
HISTOGRAM_BINS = 30
# ----------------------------------------------------------------------------------------------

#: Distinct values that one task ranks, and pieces that a slice with more of them is cut into.
SLICE_ROWS = 1_000_000
_PIECES = 16


def metric_columns(obs: str, pred: str) -> list[Column]:
    """RMSE, MAE and both R² in one pass.

    ``r2`` is one minus the ratio of squared errors to squared deviations, ``r2_corr`` the squared
    correlation. Rows without a prediction are counted in ``n_missing`` and left out of the rest.
    """
    known = F.col(obs).isNotNull() & F.col(pred).isNotNull()
    o, p = F.when(known, F.col(obs)), F.when(known, F.col(pred))
    n = F.count(F.when(known, 1))
    squared = (o - p) * (o - p)
    spread = F.var_pop(o) * n
    return [
        n.alias("n"),
        F.count(F.when(~known, 1)).alias("n_missing"),
        F.sqrt(F.avg(squared)).alias("rmse"),
        (1 - F.sum(squared) / F.nullif(spread, F.lit(0.0))).alias("r2"),
        F.pow(F.corr(o, p), F.lit(2.0)).alias("r2_corr"),
        F.avg(F.abs(o - p)).alias("mae"),
    ]


def regression_metrics(df: DataFrame, obs: str, pred: str) -> DataFrame:
    return df.agg(*metric_columns(obs, pred))


def metrics_by_group(df: DataFrame, group: str, obs: str, pred: str) -> DataFrame:
    return df.groupBy(group).agg(*metric_columns(obs, pred))


def mean_metrics(per_group: DataFrame) -> DataFrame:
    """Plain mean over the groups, whatever their sizes."""
    return per_group.agg(*[F.avg(m).alias(m) for m in ("rmse", "r2", "mae")])


def sensor_summary(
    df: DataFrame, obs: str, pred: str = "pred", sensor: str = "mq_name", scaling: str | None = None
) -> DataFrame:
    """Mean prediction and observation per sensor; the factor is the same in all its rows."""
    extra = [F.max(scaling).alias("scaling")] if scaling else []
    return df.groupBy(sensor).agg(F.avg(pred).alias("pred"), F.avg(obs).alias("obs"), *extra)


def _slice_edges(counts: DataFrame, value: str, slice_rows: int) -> list:
    """Upper ends of slices of the distinct values, in order, none with more than ``slice_rows`` of them.

    A histogram is refined: every slice that holds too many values is cut at ``_PIECES`` quantiles of
    its own, in one job for all of them, until none is left. Quantiles are exact enough to shrink
    a slice by half at least, so the jobs grow with the logarithm of the values alone; what comes to
    the driver is one value for each slice.
    """
    whole = counts.agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("high")).first()
    edges, large = [whole["high"]], [0] if whole["n"] > slice_rows else []
    while large:
        shares = [k / _PIECES for k in range(1, _PIECES)]
        found = (
            counts.withColumn("_slice", slice_of(F.col(value), edges))
            .filter(F.col("_slice").isin(large))
            .groupBy("_slice")
            .agg(F.percentile_approx(value, shares, F.lit(100 * _PIECES)).alias("cuts"))
            .collect()
        )
        before = edges
        edges = sorted(set(edges).union(*[r["cuts"] for r in found]))
        if edges == before:
            break  # slices of a single value
        sizes = counts.groupBy(slice_of(F.col(value), edges).alias("_slice")).agg(F.count(F.lit(1)).alias("n"))
        large = [r["_slice"] for r in sizes.filter(F.col("n") > slice_rows).collect()]
    return edges


def slice_of(value: Column, edges: Sequence) -> Column:
    """The place of the first edge that is not below ``value``."""
    # a binary search written as a tree of comparisons: its depth grows with the logarithm of the edges
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= F.lit(edges[middle]), between(low, middle)).otherwise(between(middle + 1, high))

    return between(0, len(edges) - 1)


def average_ranks(df: DataFrame, value: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Distinct values of a column with their average rank over all rows.

    Values are counted, cut into slices of at most ``slice_rows`` distinct values, ranked inside
    each slice, and moved up by the total of the slices below. However skewed the values are, no
    task ranks more than a slice.
    """
    counts = cut_lineage(
        df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    )
    edges = _slice_edges(counts, value, slice_rows)
    sliced = counts.withColumn("_slice", slice_of(F.col(value), edges))
    totals = sliced.groupBy("_slice").agg(F.sum("_n").alias("_total"))
    below = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_slice", F.coalesce(F.sum("_total").over(below), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = sliced.withColumn("_below", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return ranked.join(offsets, "_slice").select(
        value, (F.col("_offset") + F.col("_below") + (F.col("_n") + 1) / 2).alias("rank")
    )


def sensor_correlation(summary: DataFrame, a: str = "pred", b: str = "obs") -> DataFrame:
    """Pearson and Spearman correlation, the latter on average ranks.

    The ranks are joined back on the values, so the values must not change in the last digit
    between two runs of a mean. The summary, one row per sensor, is staged for that.
    """
    known = summary.select(a, b).filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    known = cut_lineage(known)
    ranked = known.join(average_ranks(known, a).withColumnRenamed("rank", "_rank_a"), a).join(
        average_ranks(known, b).withColumnRenamed("rank", "_rank_b"), b
    )
    return ranked.agg(
        F.corr(a, b).alias("pearson"), F.corr("_rank_a", "_rank_b").alias("spearman")
    )


def residuals(
    df: DataFrame, obs: str, pred: str = "pred", keep: Sequence[str] = ()
) -> DataFrame:
    """Observed, predicted, and observed minus predicted."""
    return df.select(
        *keep,
        F.col(obs).alias("obs"),
        F.col(pred).alias("pred"),
        (F.col(obs) - F.col(pred)).alias("resid"),
    )


def bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin 0 to ``bins - 1`` of equal width between ``low`` and ``high``; the top edge counts to
    the last bin. One single value means one bin."""
    index = F.floor((value - low) / F.nullif((high - low) / bins, F.lit(0.0)))
    inside = F.greatest(F.least(index, F.lit(bins - 1)), F.lit(0))
    return F.when(high == low, F.lit(0)).when(value.isNotNull(), inside).cast("int")


def distribution_table(
    df: DataFrame,
    obs: str,
    pred: str = "pred",
    bins: int = HISTOGRAM_BINS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Histogram counts of predictions and observations over their common range."""
    series = F.explode(
        F.array(
            F.struct(F.lit("obs").alias("series"), F.col(obs).cast("double").alias("value")),
            F.struct(F.lit("pred").alias("series"), F.col(pred).cast("double").alias("value")),
        )
    )
    limits = (
        df.agg(
            F.least(F.min(obs), F.min(pred)).cast("double").alias("low"),
            F.greatest(F.max(obs), F.max(pred)).cast("double").alias("high"),
        )
        .select(F.struct("low", "high").alias("limits"))
        .scalar()
    )
    low, high = limits["low"], limits["high"]
    values = df.select(*by, series.alias("s")).select(*by, "s.*").filter("value IS NOT NULL")
    return (
        values.groupBy(*by, "series", bin_index(F.col("value"), low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", low + F.col("bin") * ((high - low) / bins))
    )
