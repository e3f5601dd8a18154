"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    spread = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return spread.union(least.select("u", F.col("m").alias("v"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a lesser one, and no centre has such an edge itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    sides = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not sides.where("up > 1 OR (up = 1 AND down = 1)").limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (u, v long); root is the least node it reaches.

    Self-loops, repeated and reversed edges are allowed; an empty table gives an empty table.
    Minima are combined before each shuffle and no star is gathered in one place, so a node may
    have any number of neighbours. Every round is written to the shared folder.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(edges, "edges")
    while not _stars(edges):
        edges = written(_small_star(_large_star(edges)), "edges")
    return edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").union(
        edges.select("v", F.col("v").alias("root")).distinct()
    )
