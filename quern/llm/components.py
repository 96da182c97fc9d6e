"""Connected components of a table of links, by repeated contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.scratch import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); component is one node of each connected group.

    Each round points every node at its smallest neighbour and contracts the links to what they point at. Nodes are
    well-mixed hashes, so a round removes a fixed share of the remaining nodes whatever the shape. Links of a node to
    itself are ignored; nodes without other links don't appear.
    """
    edges = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    mapping = None
    while mapping is None or not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")))
        if mapping is None:
            mapping = step
        else:
            to = step.select(F.col("node").alias("component"), F.col("component").alias("next"))
            mapping = stored(mapping.join(to, "component", "left").select("node", F.coalesce("next", "component").alias("component")))
        ends = edges.join(step.select(F.col("node").alias("a"), F.col("component").alias("x")), "a").join(step.select(F.col("node").alias("b"), F.col("component").alias("y")), "b")
        edges = stored(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return mapping
