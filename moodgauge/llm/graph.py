"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodgauge.llm.tables import drop, stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b); root is one node of its component, the same for all of it.

    Each round gives every node the smallest name next to it, follows that name one step further, and contracts the graph to the
    names that are left, so at least half of the nodes with links go per round. Counting and taking a minimum combine before the
    shuffle, so a node with very many links is no hot spot. Only whether links are left reaches the driver.
    """
    left = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    roots = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to")), "nearest")
        further = near.select(F.col("node").alias("to"), F.col("to").alias("next"))
        step = stored(near.join(further, "to", "left").select("node", F.coalesce("next", "to").alias("root")), "step")
        if roots is None:
            roots_next = step
        else:
            moved = step.select(F.col("node").alias("root"), F.col("root").alias("to"))
            roots_next = stored(roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
        a = step.select(F.col("node").alias("a"), F.col("root").alias("new_a"))
        b = step.select(F.col("node").alias("b"), F.col("root").alias("new_b"))
        contracted = left.join(a, "a").join(b, "b").filter("new_a <> new_b").select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
        left_next = stored(contracted.distinct(), "links")
        drop(left, near, *([] if roots is None else [roots, step]))
        left, roots = left_next, roots_next
    return roots if roots is not None else left.select(F.col("a").alias("node"), F.col("b").alias("root"))
