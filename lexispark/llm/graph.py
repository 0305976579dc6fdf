"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import finished, stored


def _star(pairs: DataFrame, keep: str) -> DataFrame:
    """Link every neighbour v of u that ``keep`` selects to the smallest of u and its neighbours.

    The minimum is combined before the shuffle and joined back by u, a join that Spark can split,
    so a node with very many links does not fill one task.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``links`` (a, b) is connected with.

    Alternates large and small stars until the table of links no longer changes; each round is
    written to the shared folder. Nodes without links to others, and null nodes, are not listed.
    """
    return finished(lambda: _components(links))


def _components(links: DataFrame) -> DataFrame:
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u > v").distinct())
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_star(both, "v > u").where("u > v").distinct())
        small = _star(large, "v > m").unionByName(large.groupBy("u").agg(F.min("v").alias("v")))
        edges = stored(small.where("u > v").distinct())
