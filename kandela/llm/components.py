"""Connected components by alternating large and small stars, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node that can be reached) of every node of ``edges`` (``a, b``).

    Each round hangs a node's larger neighbours below its smallest one, and then a node and its
    smaller neighbours below the smallest of them, until every component is a star. No node's
    neighbours are gathered: only minima are grouped, and a node with very many neighbours is an
    ordinary skewed join key. Each round is written to the shared folder. Edges with a null or with
    equal ends link nothing; without edges the result is empty."""
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _stars(e):
            roots = e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(roots)
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        least = e.groupBy("hi").agg(F.min("lo").alias("m"))
        below = e.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = stage(below.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
    raise RuntimeError("the components are not found after so many rounds")


def _stars(e: DataFrame) -> bool:
    """Whether no node hangs below two others, or below one while others hang below it."""
    ends = e.select(F.col("hi").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(e.select(F.col("lo").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return not ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").take(1)
