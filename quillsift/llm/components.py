"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.llm.staging import staged

MAX_ROUNDS = 50


def connected(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node in ``links`` (a, b).

    Large and small stars in turn: every node hands its neighbours to the smallest of them, until
    each component is one star. No neighbourhood is gathered; nodes with many links meet their
    minimum in a join, which Spark can split.
    """
    edges = staged(spark, _downward(links.select("a", "b")), "links")
    state = None
    for _ in range(MAX_ROUNDS):
        edges = staged(spark, _small_star(_large_star(edges)), "stars")
        row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    else:
        raise ValueError("components do not settle")
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    heads = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(heads)


def _downward(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller."""
    return (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to its smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.where("b > a").join(least, "a")
    return _downward(larger.select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _downward(others.unionByName(least.select("a", F.col("m").alias("b"))))
