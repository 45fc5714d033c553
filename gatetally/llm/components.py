"""Connected components of links between 64-bit nodes, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatetally.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node that ``links`` (u, v) join to another: the least node that it reaches.

    Each round gives a node the least of itself and its neighbours, and that one's
    own choice in turn; nodes of one choice become one, and links inside it go. What
    is left shrinks from round to round, by half at least and mostly far more. Every
    round is written before the next, so it never depends on lost blocks; all steps
    are aggregations with partial minima and joins. A node only ever moves to a
    lesser one, so the last one standing is the least.
    """
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = stored(both.where("u <> v").distinct(), "links")
    labels = None
    while True:
        least = edges.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("choice"))
        further = least.select(F.col("u").alias("choice"), F.col("choice").alias("label"))
        moved = stored(least.join(further, "choice").select(F.col("u").alias("node"), "label"), "choices")
        if labels is None:
            labels = moved
        else:
            after = moved.select(F.col("node").alias("label"), F.col("label").alias("next"))
            joined = labels.join(after, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
            labels = stored(joined, "labels")
        side = lambda x, name: moved.select(F.col("node").alias(x), F.col("label").alias(name))  # noqa: E731, B023
        ends = edges.join(side("u", "a"), "u").join(side("v", "b"), "v")
        edges = stored(ends.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "links")
        if edges.isEmpty():
            return labels
