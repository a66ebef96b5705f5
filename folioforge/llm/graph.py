"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(a, b) links to (node, comp): the smallest node that each node reaches.

    Every round takes the smallest label among the neighbours, passes it on to
    the root that the node pointed to, and shortens the pointers; long chains
    shrink by half or more, stars end in one round. Labels are written to the
    shared folder each round, which cuts the lineage; counts alone reach the
    driver. Nodes are not null; links of a node to itself are allowed.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.distinct(), "edges")
    labels = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        own = labels.join(near, labels["node"] == near["a"]).select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        # Written before it is joined, so that Spark can split the rows of a hot root.
        roots = materialize(own.groupBy(F.col("old").alias("root")).agg(F.min("comp").alias("hook")), "roots")
        hooked = materialize(own.join(roots, own["old"] == roots["root"]).select("node", "old", F.least("comp", "hook").alias("comp")), "hooked")
        parents = hooked.select(F.col("node").alias("parent"), F.col("comp").alias("top"))
        jumped = hooked.join(parents, hooked["comp"] == parents["parent"]).select("node", "old", F.col("top").alias("comp"))
        after = materialize(jumped, "labels")
        moved = after.where("old <> comp").limit(1).count()
        labels = after.select("node", "comp")
        if not moved:
            return labels
