"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    """(u, least, ups, downs): the least of each u's neighbours, and how many are below and above it.

    Written, so that what it is joined to has no aggregate under the join: Spark
    can then split a node that has very many neighbours.
    """
    below = F.col("v") < F.col("u")
    least = edges.groupBy("u").agg(
        F.min("v").alias("least"), F.count_if(below).alias("ups"), F.count_if(~below).alias("downs")
    )
    return stored(least, "least")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node with an edge the least node it can reach.

    ``edges`` has columns u and v of one integer type; direction and repeats do
    not matter, loops and nulls are dropped. Alternates the large-star and
    small-star steps until every component is a star around its least node; every
    step is written to the shared folder. No edges: no rows.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(edges.distinct(), "star")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        # A star: no node has two below it, or one below and one above.
        if least.where("ups > 1 or (ups = 1 and downs > 0)").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        hung = both.join(least, "u").where("v > u")
        large = stored(hung.select(F.col("v").alias("u"), F.least("u", "least").alias("v")), "large")
        hung = large.join(_least(large), "u")
        small = hung.select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
        edges = stored(small.where("u != v").distinct(), "star")
