"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import store


def ends_of(edges: DataFrame) -> DataFrame:
    """``node``: every end of an edge ``a, b``, once."""
    return edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge ``a, b``; a component is its smallest node.

    Each round hooks every node to its smallest neighbour and redraws the edges
    between the hooked nodes, so nodes vanish until no edge is left. Tables are
    stored each round, which cuts lineage; nothing reaches the driver but whether
    edges are left. Loops and repeated edges do no harm.
    """
    ends = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    edges = store(edges.select(*ends("a", "b")).distinct(), "edges")
    rounds = []
    left = edges.filter("a <> b")
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = store(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("to")), "hooks")
        rounds.append(hooks)
        at = lambda end: hooks.select(F.col("node").alias(end), F.col("to").alias(f"{end}_to"))  # noqa: B023, E731
        hooked = left.join(at("a"), "a").join(at("b"), "b").filter("a_to <> b_to")
        left = store(hooked.select(*ends("a_to", "b_to")).distinct(), "edges")
    found = ends_of(edges).withColumn("component", F.col("node"))
    for hooks in rounds:
        step = hooks.select(F.col("node").alias("component"), "to")
        found = found.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return store(found, "components")
