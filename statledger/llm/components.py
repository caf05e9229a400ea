"""Connected components of a graph given as pairs, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statledger.session import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (or smaller) neighbours to the least of the node and its neighbours."""
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        made = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return made.where("a <> b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``(node, component)`` for every node in the pairs; a component is its least node.

    Each round is stored in the shared folder, which cuts its lineage. Rounds grow with the logarithm
    of the longest path.
    """
    first, second = pairs.columns
    edges = pairs.select(F.col(first).alias("a"), F.col(second).alias("b")).where("a <> b").distinct()
    edges = written(edges, "links")
    state = None
    while True:
        edges = written(_star(_star(edges, large=True), large=False), "links")
        found = edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
