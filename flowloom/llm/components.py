"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.plans.staging import join_staged, stage_table


def _pointed(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller end, each once, without loops."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = join_staged(around.where(F.col("b") > F.col("a")), least, ["a"])
    return _pointed(tied.select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = join_staged(edges, least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _pointed(tied.unionByName(least.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge: root is the least node it is connected to.

    ``edges`` has the long columns a and b. Each round is written to the shared folder; the
    driver reads only two numbers of it. A node with many neighbours is a hot join key on the
    edge side alone, which adaptive execution splits. No edges give no rows.
    """
    current = stage_table(_pointed(edges), "edges")
    seen = None
    while True:
        current = stage_table(_small_star(stage_table(_large_star(current), "large")), "small")
        # The sum of a 64-bit hash over the set of edges tells whether a round has changed it.
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return current.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node").unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
