"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is one grouped minimum and one join, so no component is ever gathered in one place: a
hub's links stay spread over rows, and adaptive execution splits a hub's join partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def _stars(e: DataFrame) -> bool:
    """Whether all links point straight at roots: every u once, and no v is a u itself."""
    twice = e.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
    inner = e.join(e.select(F.col("v").alias("root")).distinct(), F.col("u") == F.col("root"), "left_semi").select("u")
    return twice.unionAll(inner).count() == 0


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of u, and u's smallest neighbour: (neighbour, smallest)."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v"))


def _small_star(e: DataFrame) -> DataFrame:
    """Of links (u, v) with v < u: u and its smaller neighbours all point at the smallest."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(u, v): each linked node ``u`` and the smallest node ``v`` it can reach, itself included.

    ``links`` has two long columns ``a`` and ``b``, in either order, repeats and self-links allowed; no
    links give no rows. Rounds end when every link points straight at a root; their number grows with the
    logarithm of the longest chain. A round's output is written to the shared folder, so a lost executor
    repeats one round at most.
    """
    e = (links.where("a != b and a is not null and b is not null")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = written(e, "links")
    while not _stars(e):
        e = written(_small_star(_large_star(e)), "links")
    roots = e.select(F.col("v").alias("u"), "v").distinct()
    return e.union(roots)
