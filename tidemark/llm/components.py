"""Connected components of a table of links, with the smallest id as label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (a long, b long) to (id, component) for every id in a link.

    Alternating large-star and small-star steps: each round hangs neighbours onto
    the smallest id in sight, so chains halve and no edge set ever grows. Every
    round is a written table; nothing but two counts comes to the driver.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = cut(edges, "links")
    before = (0, None)
    for _ in range(max_rounds):
        if before == (0, None) and not edges.count():
            break
        edges = cut(_small_star(_large_star(edges)), "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of x is hung onto the smallest of x and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u").filter("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """x and its smaller neighbours are hung onto the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return down.unionByName(own).filter("u <> v").distinct()
