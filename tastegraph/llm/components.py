"""Connected components of a graph given by its edges, in star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.session import discard, written


def _neighbours(edges: DataFrame) -> DataFrame:
    """(a, b): every edge from both of its ends."""
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(edges: DataFrame) -> DataFrame:
    """(a, m, up, down) of every node a: its smallest neighbour, how many are smaller, is any larger. Written."""
    smaller = F.sum((F.col("b") < F.col("a")).cast("bigint"))
    return written(_neighbours(edges).groupBy("a").agg(F.min("b").alias("m"), smaller.alias("up"), F.max(F.col("b") > F.col("a")).alias("down")))


def _is_stars(least: DataFrame) -> bool:
    """Does every node that points to a smaller one point to one only, which points nowhere?"""
    return least.agg(F.max((F.col("up") > 1) | (F.col("up") > 0) & F.col("down"))).head()[0] is not True


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the component's smallest node.

    Alternates large-star and small-star steps: every node hands its neighbours over to the
    smallest one it knows, until each component is a star. Minima are aggregated before the
    shuffle. Each round is written, so a lost executor does not undo the rounds before; so are
    the minima, which the test for stars and the large star both read.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _is_stars(nearest := _least(now)):
        # Large star: the larger neighbours of a node go to its minimum.
        least = nearest.select("a", F.least("a", "m").alias("m"))
        large = _neighbours(now).filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: the smaller neighbours and the node itself go to its minimum.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        before, now = now, written(small.filter("a <> b").distinct())
        discard(before, nearest)
    discard(nearest)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
