"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for all nodes of edges ``a``, ``b``.

    Every node points to its smallest neighbour, pointers are followed once more, and the graph is
    contracted along them, until no edge is left; a round at least halves the nodes that still
    have edges. Hubs are only ever grouped by a minimum, which is taken before rows are shuffled.
    Each round is written to the shared folder. Edges with a null end are left out.
    """
    found = None
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")).select(F.col("a").alias("node"), "up"), "pointers")
        next_ = first.select(F.col("node").alias("via"), F.col("up").alias("top"))
        up = stored(first.join(next_, first["up"] == next_["via"]).select("node", "top"), "pointers")
        if found is None:
            found = up.select("node", F.col("top").alias("component"))
        else:
            ends = up.select(F.col("node").alias("old"), "top")
            found = found.join(ends, found["component"] == ends["old"], "left").select("node", F.coalesce("top", "component").alias("component"))
        found = stored(found, "components")
        left, right = up.select(F.col("node").alias("a"), F.col("top").alias("x")), up.select(F.col("node").alias("b"), F.col("top").alias("y"))
        moved = edges.join(left, "a").join(right, "b").filter("x <> y")
        edges = stored(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) if found is None else found
