"""Connected components of a link table by alternating star steps, in Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node among it and its neighbours."""
    both = _both(links)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """node, component (its least reachable node) for every node of links(a, b).

    The result reads one table in the shared folder; those of earlier rounds are deleted.

    Links with a null end or with a = b count for nothing; an empty table gives an empty one.  Each
    round halves the depth of the trees at least, and a round that changes nothing ends the work;
    more than most_rounds rounds raise an error rather than return unfinished labels.
    """
    scratch = Scratch(links.sparkSession)
    now = scratch.stored(links.select("a", "b").filter("a <> b").distinct(), "star")
    was = None
    for _ in range(most_rounds):
        now = scratch.stored(_small_star(_large_star(now)), "star")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == was or not state["n"]:
            break
        was = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.union(roots)
