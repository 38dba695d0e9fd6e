"""Connected components of a link table, as joins and minima on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b) links to (node, component): the least node that links reach.

    Alternating stars: every node hands its least neighbour to the greater
    ones, then to the lesser ones, until only a star around each least node is left.
    Minima combine before the shuffle and the joins can be split where
    a node has very many links. Each round is cut with checkpoint(), so a
    lost executor repeats one round at most. Nodes without links don't appear.
    """
    checkpoint_dir(links.sparkSession)
    links = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct().checkpoint()
    before = _state(links)
    while before[0]:
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        links = small.union(least.select("k", "m")).distinct().checkpoint()
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
