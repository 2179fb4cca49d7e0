"""Sources mixed to target weights by drawing how often each document is repeated."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgrid.llm.common import packed, staged

SEED = 17
#: A draw is inverted for means up to this; larger means are sums of draws of equal smaller means.
_MEAN = 16
#: Poisson counts beyond this have, at a mean of 16, less than a double's precision.
_COUNTS = 80
#: Tables of rates of up to so many sources are broadcast (under 1 KB each).
BROADCAST_SOURCES = 20_000


def _uniform(*parts: Column) -> Column:
    """Between 0 and 1, from 52 bits of the MD5 of the parts' text."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def rates(
    docs: DataFrame, weights: Mapping[str, float] | None = None, power: float = 0.5, size: float = 1.0
) -> DataFrame:
    """(source, n_docs, rate): how often a document of each source is wanted on average.

    ``weights`` names the targets; sources it lacks get none. Without it a source's weight is its
    number of documents to the ``power``. Over all sources, ``size`` times as many documents are
    wanted as there are. A null source is one of its own, with the weight of ``None``.
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        root = F.sqrt if power == 0.5 else lambda c: F.pow(c, F.lit(power))
        counts = counts.withColumn("weight", root(F.col("n_docs").cast("double")))
    else:
        chosen = F.lit(0.0)
        for source, weight in weights.items():
            chosen = F.when(F.col("source").eqNullSafe(source), float(weight)).otherwise(chosen)
        counts = counts.withColumn("weight", chosen)
    totals = counts.agg(F.sum("weight").alias("all_weights"), F.sum("n_docs").alias("all_docs")).head()
    per_weight = size * (totals["all_docs"] or 0) / (totals["all_weights"] or math.inf)
    return counts.select("source", "n_docs", (F.col("weight") * per_weight / F.col("n_docs")).alias("rate"))


def _cumulative(mean: Column) -> Column:
    """P(count <= k) for k from 0, as an array."""
    zero = F.exp(-mean)
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(_COUNTS)),
        F.struct(F.array(zero).alias("cdf"), zero.alias("p"), zero.alias("sum")),
        lambda s, k: F.struct(
            F.array_append(s["cdf"], s["sum"] + s["p"] * mean / k).alias("cdf"),
            (s["p"] * mean / k).alias("p"),
            (s["sum"] + s["p"] * mean / k).alias("sum"),
        ),
    )
    return steps["cdf"]


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    power: float = 0.5,
    size: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` repeated to the target weights and shuffled: all columns, ``copy``, ``shuffle_key``.

    Each document's number of copies is a Poisson draw with the mean of its source's rate: the
    smallest count whose cumulative probability reaches a uniform number, which is a hash of the
    seed and the id. So the draw is the same in every run and however the data are partitioned;
    rows that repeat an id are drawn alike, and a null id has the hash of an empty text. Copies
    count from 1. The result is in the order of ``shuffle_key``, another hash, over all
    partitions. An empty table gives an empty one. Columns of these two names are replaced.
    """
    spark = docs.sparkSession
    table = staged(rates(docs.select("source"), weights, power, size), "rates")
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / _MEAN).cast("int"))
    table = table.filter("rate > 0").select(
        F.col("source").alias("of_source"), draws.alias("draws"), _cumulative(F.col("rate") / draws).alias("cdf")
    )
    if table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    kept = docs.drop("copy", "shuffle_key")
    rows = packed(kept, "source").withColumn(
        "id", F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))
    )
    found = rows.join(table, rows["source"].eqNullSafe(table["of_source"]))
    one = lambda i: F.size(
        F.filter("cdf", lambda c: c < _uniform(F.lit(f"draw-{seed}"), F.col("id"), i.cast("string")))
    )
    found = found.select(
        "row", "id", F.aggregate(F.sequence(F.lit(1), F.col("draws")), F.lit(0), lambda n, i: n + one(i)).alias("n")
    ).filter("n > 0")
    copies = found.select("row", "id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    digits = F.substring(
        F.md5(F.concat_ws(":", F.lit(f"order-{seed}"), "id", F.col("copy").cast("string"))), 1, 15
    )
    copies = copies.select("row", "copy", F.conv(digits, 16, 10).cast("bigint").alias("shuffle_key"))
    # The keys are uniform over 60 bits: equal ranges are equal shares, without sampling for borders.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = F.floor(F.col("shuffle_key") / float(1 << 60) * parts).cast("int")
    ordered = copies.repartitionById(parts, F.least(share, F.lit(parts - 1)))
    return ordered.sortWithinPartitions("shuffle_key", "copy").select("row.*", "copy", "shuffle_key")


SQL = f"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n_docs FROM documents GROUP BY source),
rates AS (
  SELECT source, sqrt(n_docs) * (SELECT sum(n_docs) FROM counts)
         / (SELECT sum(sqrt(n_docs)) FROM counts) / n_docs AS rate
  FROM counts
),
means AS (SELECT source, greatest(1, ceil(rate / {_MEAN}))::BIGINT AS draws,
                 rate / greatest(1, ceil(rate / {_MEAN})) AS mean FROM rates),
cdf AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM means
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < {_COUNTS}
),
uniforms AS (
  SELECT d.doc_id, d.source, i,
         (CAST('0x' || substr(md5(concat_ws(':', 'draw-{SEED}', d.doc_id, i)), 1, 13) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM documents d JOIN means m ON m.source IS NOT DISTINCT FROM d.source,
       unnest(generate_series(1, m.draws)) AS s(i)
),
drawn AS (
  SELECT u.doc_id, count(*) AS n FROM uniforms u
  JOIN cdf ON cdf.source IS NOT DISTINCT FROM u.source AND cdf.c < u.u GROUP BY u.doc_id
)
SELECT d.*, CAST(c AS INTEGER) AS copy,
       CAST('0x' || substr(md5(concat_ws(':', 'order-{SEED}', d.doc_id, c)), 1, 15) AS BIGINT) AS shuffle_key
FROM documents d JOIN drawn USING (doc_id), unnest(generate_series(1, n)) AS s(c)
"""
