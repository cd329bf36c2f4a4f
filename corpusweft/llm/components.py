"""Connected components of a table of links, by contraction in the shared folder.

Each round gives every node its smallest neighbour, or itself, as parent, follows parents
to their roots by doubling (a chain of n parents takes log2 n steps), and replaces links
by links of roots. A node without a smaller neighbour that nobody chose has one in the
next round, so two rounds leave at most half the nodes, and a root is always the smallest
node of its tree. No node's links are ever gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import forget, written


def rooted(parent: DataFrame) -> DataFrame:
    """(node, p) with p the root, of a written table (node, p) in which every p is a node too."""
    while True:
        up = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        if parent.join(up, "p").where("p <> pp").isEmpty():
            return parent
        twice = parent.join(up, "p").select("node", F.col("pp").alias("p"))
        nxt = written(twice.join(up, "p").select("node", F.col("pp").alias("p")), "parents")  # three steps up at once
        forget(parent)
        parent = nxt


def components(links: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """(node, component) of every node that has a link in (a, b); component: its smallest node.

    A round writes one table of parents, and one of the links that are left, if any are.
    ``rounds``, if given, gets the number of rounds.
    """
    edges = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels, n, parents, more = None, 0, [], True
    while more:
        n += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = rooted(written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("p")), "parents"))
        parents.append(parent)
        if labels is None:
            labels = parent.select("node", F.col("p").alias("component"))
        else:
            moved = parent.select(F.col("node").alias("component"), F.col("p").alias("up"))
            labels = labels.join(moved, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        pa = parent.select(F.col("node").alias("a"), F.col("p").alias("pa"))
        pb = parent.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        left = edges.join(pa, "a").join(pb, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        more = not left.isEmpty()
        if more:
            nxt = written(left.distinct(), "links")
            forget(edges)
            edges = nxt
    if len(parents) > 1:
        labels = written(labels, "labels")
        for parent in parents:
            forget(parent)
    forget(edges)
    if rounds is not None:
        rounds.append(n)
    return labels
