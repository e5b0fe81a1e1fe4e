"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: hang a node's larger (or not larger) neighbours onto its smallest one. Rows may repeat."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    # Edges run from the larger end a to the smaller end b.
    least = both.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("of"), F.least("a", "low").alias("low")
    )
    joined = both.join(least, F.col("a") == F.col("of"))
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
    return moved.where(F.col("a") > F.col("b"))


def _moves(edges: DataFrame) -> bool:
    """Whether a node hangs on two others, or on one that hangs itself: else all are stars, which no step would change."""
    ends = edges.select(F.explode(F.array(F.struct("a", F.lit(1).alias("up")), F.struct(F.col("b").alias("a"), F.lit(0).alias("up")))).alias("e"))
    nodes = ends.groupBy("e.a").agg(F.sum("e.up").alias("ups"), F.count(F.lit(1)).alias("ends"))
    return bool(nodes.agg(F.max((F.col("ups") > 1) | F.col("ups").between(1, F.col("ends") - 1))).first()[0])


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, component) for the nodes of links (a, b); a component is its smallest node.

    Large and small stars in turn until nothing moves: every step at least halves long
    paths, and a step joins edges with one minimum per node, gathering no neighbours. Nodes
    that are their component's smallest may be left out. ``known``, the result for other links, is
    carried on with: the components are those of both, found in the few steps that the new links ask for.
    Stars are stored between steps, as each step reads them twice.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") > F.col("b"))
    if known is not None:
        stars = known.select(F.col("node").alias("a"), F.col("component").alias("b")).where(F.col("a") > F.col("b"))
        edges = edges.unionByName(stars)
    edges = store(edges.distinct(), "links")
    while _moves(edges):
        hung = store(_star(edges, large=True), "links")
        edges = store(_star(hung, large=False).distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
