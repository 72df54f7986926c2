"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v), any orderable type -> (u, v) where v is the smallest
    node of u's component; nodes that are their own smallest have no row. Each
    round reads and writes linear in the links; the number of rounds grows with
    the logarithm of the nodes. Nulls and loops are no links. No links, no rows."""
    edges = stage(links.select("u", "v").filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges, last = stage(_small_star(_large_star(edges)), "edges"), mark
        mark = _mark(edges)
        if mark == last:
            break
    return edges
