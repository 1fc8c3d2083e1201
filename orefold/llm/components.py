"""Connected components by alternating stars, all in shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for the ends of edges ``a, b``; ``root`` is the least node reachable.

    Every round hangs all larger neighbours of a node on its least neighbour, then all
    smaller ones. The number of edges never grows, a round is joins and combined minima,
    and rounds grow with the logarithm of the longest path.
    """
    star = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    mark = _mark(star)
    while mark[0]:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select("e.a", F.col("e.m").alias("b")).where("a <> b").distinct()
        )
        star, before = stored(small, "links"), mark
        mark = _mark(star)
        if mark == before:
            break
    roots = star.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return star.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Rows and an order-free sum over them: equal if nothing has changed."""
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())
