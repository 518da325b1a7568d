"""Connected components of links, by contracting each vertex into its smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.scratch import discard, settle


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of the links (a, b): the smallest id that links reach.

    Every round joins vertices to the smallest of their neighbours and to that
    one's own, and rewrites the links between what they became; links within
    one vertex go.  Each table is written, so that a lost executor re-reads it
    and a vertex with very many links can be split in the joins.  Links may
    repeat and point either way.  No links give no rows.
    """
    edges = settle(_between(links.select(F.col("a").alias("x"), F.col("b").alias("y"))), "links")
    members = None
    while members is None or not edges.isEmpty():
        both = edges.select(F.col("x").alias("v"), F.col("y").alias("u"))
        both = both.unionByName(edges.select(F.col("y").alias("v"), F.col("x").alias("u")))
        near = settle(both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("to")), "nearest")
        far = near.select(F.col("v").alias("to"), F.col("to").alias("root"))
        roots = near.join(far, "to").select("v", "root")
        if members is None:
            merged = settle(roots, "members")
        else:
            moved = roots.select(F.col("v").alias("root"), F.col("root").alias("next"))
            merged = members.join(moved, "root", "left").select("v", F.coalesce("next", "root").alias("root"))
            merged = settle(merged, "members")
            discard(members)
        rx = roots.select(F.col("v").alias("x"), F.col("root").alias("rx"))
        ry = roots.select(F.col("v").alias("y"), F.col("root").alias("ry"))
        moved = edges.join(rx, "x").join(ry, "y").select(F.col("rx").alias("x"), F.col("ry").alias("y"))
        rest = settle(_between(moved), "links")
        discard(edges, near)
        edges, members = rest, merged
    discard(edges)
    return members.select(F.col("v").alias("id"), F.col("root").alias("component"))


def _between(edges: DataFrame) -> DataFrame:
    low, high = F.least("x", "y"), F.greatest("x", "y")
    return edges.filter("x <> y").select(high.alias("x"), low.alias("y")).distinct()
