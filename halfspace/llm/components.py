"""Connected components by contracting edges, round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfspace.llm.common import shared_table


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` of every node with an edge; equal labels, one component.

    ``edges`` has the bigint columns ``a`` and ``b``, whose values should be spread like
    hashes. In a round each node points to its smallest neighbour or itself, and edges
    are carried over to what their ends point to. Connected nodes stay connected, and
    the nodes left are a fraction of those before, so the rounds grow with the logarithm
    of the longest path. A hub's edges meet in one node in its first round; its minimum
    is taken inside the tasks first. Each round's tables are written to the shared
    folder.
    """
    steps: list[DataFrame] = []
    links = edges.where("a <> b").select("a", "b")
    both = shared_table(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    while True:
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        points = shared_table(
            least.select("node", F.least("node", "least").alias("label")), "components"
        )
        steps.append(points)
        to_a = points.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
        to_b = points.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
        carried = both.join(to_a, "a").join(to_b, "b").where("label_a <> label_b")
        both = shared_table(
            carried.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct(),
            "edges",
        )
        if both.isEmpty():
            break
    labels = steps[0]
    for step in steps[1:]:
        onward = step.select(F.col("node").alias("label"), F.col("label").alias("onward"))
        labels = labels.join(onward, "label", "left").select(
            "node", F.coalesce("onward", "label").alias("label")
        )
    return labels
