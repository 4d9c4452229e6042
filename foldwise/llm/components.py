"""Connected components of an edge table by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foldwise.session import materialise

#: Far above what a contraction that halves the nodes needs; reaching it is an error, not a result.
MAX_ROUNDS = 200


def components(edges: DataFrame) -> DataFrame:
    """Label the ends of ``edges`` (columns a, b) with a root that their component shares.

    Each round every node points to the best of its neighbours and itself, and edges move to the
    nodes pointed to. Best is the node of most links, so that a group of copies around one of them
    is contracted in one round; among equals it is that of the largest hash, salted with the
    round, so that chains take logarithmically many rounds. Links are counted and the best is
    found by partial aggregates, so a node with many links never gathers them.

    Both sides of every join grow with the edges, so they are merged and nothing is broadcast.

    Returns node, root; nodes without an edge to another node are absent. NULL ends, loops and
    repeated edges don't matter; an empty table gives an empty one.
    """
    live = edges.select("a", "b").where("a <> b").distinct()
    pointers = []
    for r in range(MAX_ROUNDS):
        live = materialise(live)
        if live.isEmpty():
            break
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degrees = both.groupBy(F.col("a").alias("b")).agg(F.count(F.lit(1)).alias("n"))
        order = F.struct("n", F.xxhash64(F.lit(r), F.col("b")).alias("h"), F.col("b").alias("to"))
        near = both.join(degrees.hint("merge"), "b").select("a", order.alias("o"))
        own = degrees.select(F.col("b").alias("a"), order.alias("o"))
        points = materialise(
            near.unionByName(own).groupBy(F.col("a").alias("node")).agg(F.max("o").alias("o"))
            .select("node", F.col("o.to").alias("root"))
        )
        pointers.append(points)
        live = (
            live.join(points.select(F.col("node").alias("a"), F.col("root").alias("ra")).hint("merge"), "a")
            .join(points.select(F.col("node").alias("b"), F.col("root").alias("rb")).hint("merge"), "b")
            .where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
        )
    else:
        raise RuntimeError("the contraction did not end")
    if not pointers:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    labels = pointers.pop()
    while pointers:
        onward = labels.select(F.col("node").alias("root"), F.col("root").alias("last"))
        labels = pointers.pop().join(onward.hint("merge"), "root", "left").select(
            "node", F.coalesce("last", "root").alias("root")
        )
        labels = materialise(labels)
    return labels
