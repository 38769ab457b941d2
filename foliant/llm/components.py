"""Connected components by contraction, as DataFrame joins.

Each round points every node at its least neighbour, flattens the pointers by doubling, and replaces links
by those between the roots; the nodes that still have links at least halve. Every round is a written
table, so a lost executor repeats one round at most.

Cases: links of a node with itself, repeated ones and either order of a pair make no difference; a link with a null end is
none; no links give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def components(links: DataFrame, keep=keep) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the same for all nodes that are connected.

    ``keep`` writes and rereads a table.
    """
    both = lambda e: e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = keep(both(links), "links")
    found = None
    while not links.isEmpty():
        ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = keep(ways.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), "roots")
        while True:
            next_up = up.select(F.col("node").alias("root"), F.col("root").alias("to"))
            flat = keep(up.join(next_up, "root").select("node", F.col("to").alias("root"), (F.col("to") != F.col("root")).alias("moved")), "roots")
            up = flat.select("node", "root")
            if flat.where("moved").isEmpty():
                break
        end = lambda c: up.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
        links = keep(both(links.join(end("a"), "a").join(end("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))), "links")
        if found is None:
            found = up
        else:
            later = up.select(F.col("node").alias("root"), F.col("root").alias("to"))
            found = keep(found.join(later, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")) if found is None else found


def joined(root_of: DataFrame | None, links: DataFrame, keep=keep) -> DataFrame:
    """(node, root) of all links so far: ``root_of`` (node, root) of earlier ones, and ``links`` (a, b)."""
    if root_of is None:
        return components(links, keep)
    root = lambda c: root_of.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    lifted = links.join(root("a"), "a", "left").join(root("b"), "b", "left")
    more = components(lifted.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")), keep)
    # nodes of the second graph are roots of the first, or nodes without links there
    moved = root_of.join(more.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return keep(moved.unionByName(more.join(root_of.select("node"), "node", "left_anti")), "roots")
