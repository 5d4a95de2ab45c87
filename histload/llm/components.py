"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histload.llm.tables import checkpointed, checkpointed_with, maybe_broadcast

LABEL_BYTES = 48  # of a node and its label in a broadcast


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``label``): the smallest node of each node's component. ``edges``: ``a``, ``b``."""
    return counted_components(edges)[0]


def counted_components(edges: DataFrame) -> tuple[DataFrame, int]:
    """``components`` and the number of its rows.

    Each round takes the smallest label among a node and its neighbours, then the label's own label;
    so the number of rounds grows with the logarithm of a chain's length. A node with very many
    links is met by partial minima before the shuffle, and by AQE's split of skewed joins. While labels
    are few, they are broadcast to the links, and a round shuffles these minima alone.
    """
    links = edges.where(F.col("a") != F.col("b"))
    pairs = (("a", "b"), ("b", "a"), ("a", "a"), ("b", "b"))  # every node is its own neighbour
    both = reduce(DataFrame.union, (links.select(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in pairs))
    both = checkpointed(both.distinct())
    first = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels, seen = checkpointed_with(first, rows=F.count(F.lit(1)))
    while True:
        size = seen["rows"] * LABEL_BYTES
        near = maybe_broadcast(labels.select(F.col("node").alias("b"), F.col("label").alias("near")), size)
        own = F.max(F.when(F.col("a") == F.col("b"), F.col("near")))
        lowest = both.join(near, "b").groupBy(F.col("a").alias("node"))
        lowest = lowest.agg(F.min("near").alias("label"), own.alias("before"))
        roots = maybe_broadcast(labels.select(F.col("node").alias("label"), F.col("label").alias("root")), size)
        stepped = lowest.join(roots, "label").select("node", F.least("label", "root").alias("label"), "before")
        changed = F.count_if(F.col("label") != F.col("before"))
        moved, seen = checkpointed_with(stepped, rows=F.count(F.lit(1)), changed=changed)
        labels = moved.select("node", "label")
        if not seen["changed"]:
            return labels, seen["rows"]
