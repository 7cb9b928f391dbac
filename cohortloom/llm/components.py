"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.stored import stored


def _closer(edges: DataFrame) -> DataFrame:
    """Link both ends of every edge to the smallest node next to its larger or smaller end.

    Minima are folded before the shuffle; the join with them is skewed only on the side of the
    edges, which AQE splits.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
    far = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    # far is (larger node, root of the smaller one): hang every node's roots under their smallest
    lowest = far.groupBy("a").agg(F.min("b").alias("root"))
    near = far.join(lowest, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    own = lowest.select("a", F.col("root").alias("b"))
    return near.unionByName(own).where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` for every node of ``edges`` (``a``, ``b``): the smallest node it reaches.

    Loops and repeated edges change nothing; null ends are left out. Rounds grow with the logarithm
    of the longest path; each is stored, so a lost executor costs one round at most.
    """
    current = stored(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(current)
    while mark[0]:
        following = stored(_closer(current), "links")
        now = _mark(following)
        if now == mark:
            break
        current, mark = following, now
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
