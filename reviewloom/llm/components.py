"""Connected components of a table of links, by large and small stars.

Every round points each node at the smallest node it has met, first over all its
neighbours (large star), then over the smaller ones (small star), until nothing
changes: a logarithmic number of rounds. A round is written out, so lineage stays
short. Minima combine before they move; hot nodes meet in joins only, which
adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import written


def _smallest_neighbours(links: DataFrame) -> DataFrame:
    """Per node ``a`` the smallest of itself and its neighbours ``b``."""
    return links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))


def _star(links: DataFrame) -> DataFrame:
    """Links (a > b), each node of a star pointing at its centre."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = (
        both.join(_smallest_neighbours(both), "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )
    low = _smallest_neighbours(large)
    own = low.select("a", F.col("low").alias("b"))
    others = large.join(low, "a").where(F.col("b") > F.col("low"))
    return own.union(others.select(F.col("b").alias("a"), F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of a link; the root is the smallest node.

    ``links`` has two columns of one orderable type, without NULL.
    """
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    links = written(links.where("a > b").distinct(), "links")
    seen = _summary(links)
    while True:
        links = written(_star(links), "stars")
        now = _summary(links)
        if now == seen:
            break
        seen = now
    roots = links.select("b").distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )


def _summary(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
