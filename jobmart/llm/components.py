"""Connected components by label propagation with shortcuts, every step a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import discard, written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for all ends of ``edges (a long, b long)``: the smallest node that can be reached.

    Labels take the smallest label among their neighbours', then that label's own label, until nothing
    changes. The labels of each round are landed, which cuts the lineage, and those of the round before are
    deleted. An edge from a node to itself makes it a component; edges without one of their ends are left
    out; no edges give no rows.
    """
    whole = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    both = written(whole.unionByName(whole.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label")
        least = near.unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
        shortcut = least.select(F.col("node").alias("label"), F.col("label").alias("further"))
        following = written(least.join(shortcut, "label").select("node", F.col("further").alias("label")), "labels")
        settled = following.join(labels, ["node", "label"], "left_anti").isEmpty()
        discard(labels)
        labels = following
        if settled:
            discard(both)
            return labels
