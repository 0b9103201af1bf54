"""Connected components of a table of links, with joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b): the least node that is reachable.

    Every node takes the least label among its neighbours, then the label of its label,
    until nothing changes. Labels are written after each round.
    """
    edges = links.select(F.col("a").alias("node"), F.col("b").alias("near"))
    edges = stored(edges.unionByName(edges.select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct(), "edges")
    labels = stored(
        edges.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("component")), "labels"
    )
    while True:
        seen = labels.select(F.col("node").alias("near"), F.col("component").alias("seen"))
        least = edges.join(seen, "near").groupBy("node").agg(F.min("seen").alias("least"))
        moved = labels.join(least, "node").select(
            "node",
            F.col("component").alias("old"),
            F.least("component", "least").alias("label"),
        )
        roots = labels.select(F.col("node").alias("label"), F.col("component").alias("root"))
        moved = stored(
            moved.join(roots, "label").select(
                "node", "old", F.least("label", "root").alias("component")
            ),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.filter("component != old").isEmpty():
            return labels
