"""Connected components of a graph given by links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of a link (a, b); component is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label
    of the label, so chains halve. A round's labels are written to the shared
    folder; aggregation is partial, so a node with very many links is no burden,
    and adaptive execution splits the joins at such nodes. Links to oneself and
    repeated links do no harm; null nodes are left out.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = stored(links.union(links.select("b", "a")).union(links.select("a", "a")).union(links.select("b", "b")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b")
        nearest = seen.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("component"))
        jumped = nearest.join(labels.select(F.col("node").alias("component"), F.col("component").alias("next")), "component")
        now = stored(jumped.select("node", F.col("next").alias("component")), "labels")
        moved = now.join(labels.withColumnRenamed("component", "before"), "node").where("component <> before")
        if moved.isEmpty():
            return now
        labels = now
