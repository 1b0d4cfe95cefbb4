"""Connected components of a table of links by alternating star contractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.tables import written


def _checksum(edges: DataFrame) -> tuple:
    parts = F.xxhash64("a", "b") % (1 << 40)
    return tuple(edges.agg(F.count("*"), F.sum(parts)).first())


def _star(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """Link the neighbours of each node with the smallest of them and the node itself.

    Edges are (a, b) with a > b. The large star moves larger neighbours, the small
    star smaller ones and the node. The smallest neighbour is an aggregate that
    combines before the shuffle and comes back by a join, so a node with many links
    needs no task of its own.
    """
    if smaller_only:
        directed = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    else:
        directed = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    least = directed.groupBy("u").agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("u", "m")).hint("merge")
    moved = directed.join(least, "u")
    if smaller_only:
        moved = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    else:
        moved = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of the links (a, b).

    Links may come in any direction, repeated, or from a node to itself; links with
    a missing end count for nothing. Ends in a number of rounds that grows with the
    logarithm of the nodes; each round is written, so a lost executor repeats one.
    """
    stars = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = _checksum(stars)
    while True:
        stars = written(_star(_star(stars, False), True), "stars")
        after = _checksum(stars)
        if after == before:
            break
        before = after
    tops = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        tops.withColumn("component", F.col("node"))
    )
