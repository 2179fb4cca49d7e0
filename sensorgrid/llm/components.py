"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgrid.session import remove_path, work_path


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node reaches.

    ``edges`` has bigint columns ``a`` and ``b``. Returns (node, root) for every node with an
    edge; loops alone give no component. No edges give an empty table.

    Every node points to a parent, at first its smallest neighbour. A round offers each node and
    its parent the grandparents of its neighbours and halves the paths to the roots, so the number
    of rounds grows with the logarithm of the longest path. Offers are reduced by ``min``, which
    combines before the shuffle; joins against a popular parent are plain shuffled joins, which
    adaptive execution splits. Each round is a table in the shared folder, and the one before is
    deleted.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links_path = work_path(spark, "links")
    both.filter("a <> b").distinct().write.parquet(links_path)
    links = spark.read.parquet(links_path)

    path = work_path(spark, "parents")
    first = links.groupBy("a").agg(F.min("b").alias("b"))
    first.select(
        F.col("a").alias("node"), F.least("a", "b").alias("parent"), F.lit(True).alias("moved")
    ).write.parquet(path)
    while True:
        parents = spark.read.parquet(path)
        if parents.filter("moved").isEmpty():
            remove_path(spark, links_path)
            return parents.select("node", F.col("parent").alias("root"))
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        with_grand = parents.select("node", "parent").join(up, "parent")
        seen = links.join(
            with_grand.select(F.col("node").alias("b"), F.col("grand").alias("offer")), "b"
        ).select("a", "offer")
        offers = seen.groupBy("a").agg(F.min("offer").alias("offer"))
        offers = offers.join(parents.withColumnRenamed("node", "a"), "a")
        best = (
            offers.select(F.col("a").alias("node"), "offer")
            .union(offers.select(F.col("parent").alias("node"), "offer"))
            .union(with_grand.select("node", F.col("grand").alias("offer")))
            .groupBy("node")
            .agg(F.min("offer").alias("offer"))
        )
        nxt = work_path(spark, "parents")
        parents.join(best, "node").select(
            "node",
            F.least("parent", "offer").alias("parent"),
            (F.col("offer") < F.col("parent")).alias("moved"),
        ).write.parquet(nxt)
        remove_path(spark, path)
        path = nxt
