"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import by_part, discard, part_of, parts_held, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long); ``component`` is
    the smallest node reachable.

    Alternates the large-star and small-star steps of the published two-phase
    algorithm, which need a logarithmic number of rounds in practice. Each step
    attaches a node's neighbours to its smallest neighbour. The minimum per node
    is a map-side combined aggregate, and it is joined back to the links, so a
    node with very many links is never one task's list: its links are dealt to parts by
    their other end, and the minimum is repeated for the parts that hold links. Each round is written to
    the shared checkpoint folder and the one before it is deleted.
    """
    spark = links.sparkSession
    edges = stored(spark, _oriented(links), "links")
    while not _are_stars(edges):
        large = stored(spark, _large_star(edges), "links")
        after = stored(spark, _small_star(large), "links")
        discard(spark, edges, large)
        edges = after
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node only, which itself hangs on none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return nodes.where("hangs > 1 or (hangs = 1 and holds = 1)").isEmpty()


def _oriented(links: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller node, without loops."""
    return (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    # Neighbours larger than the node attach to the smallest of its neighbourhood.
    both = edges.union(edges.select("b", "a")).withColumn("_x_part", part_of("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), parts_held())
    least = stored(edges.sparkSession, by_part(least), "links-least")
    return (
        both.join(least, ["a", "_x_part"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    # The node and its smaller neighbours attach to the smallest of them.
    edges = edges.withColumn("_x_part", part_of("b"))
    least = edges.groupBy("a").agg(F.min("b").alias("m"), parts_held())
    least = stored(edges.sparkSession, by_part(least), "links-least")
    joined = edges.join(least, ["a", "_x_part"])
    return (
        joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b"))).distinct()
    )
