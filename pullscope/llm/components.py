"""Connected components of a large edge list by label spreading with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pullscope.llm.text import stored


def components(edges: DataFrame, folder: str) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b: long); root is the smallest node
    reachable.

    Each round lowers every node's label to the smallest label next to it, hooks the old label
    to the new one as well, and then follows labels once (label of the label), so that chains
    shorten by a constant factor. Every step is an aggregate by node or a join on it: a node with
    a million neighbours is pre-aggregated on the map side. Labels are written to the shared
    folder each round; only the number of changed labels reaches the driver.
    """
    both = stored(edges.select(F.col("a"), F.col("b")).union(edges.select(F.col("b"), F.col("a"))).distinct(),
                  f"{folder}/edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                    .select("node", F.least("node", "low").alias("root")), f"{folder}/labels-0")
    k = 0
    while True:
        k += 1
        near = (both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), F.col("root").alias("low")))
        around = near.groupBy("node").agg(F.min("low").alias("low"))
        met = labels.join(around, "node").select("node", "root", F.least("root", "low").alias("low"))
        hooks = (met.where("low < root").groupBy(F.col("root").alias("node")).agg(F.min("low").alias("hook")))
        moved = (met.join(hooks, "node", "left")
                 .select("node", F.col("root").alias("old"), F.least("low", F.coalesce("hook", "low")).alias("root")))
        moved = stored(moved, f"{folder}/moved-{k}")
        ends = moved.select(F.col("node").alias("root"), F.col("root").alias("end"))
        jumped = (moved.join(ends, "root").select("node", "old", F.least("root", "end").alias("root")))
        jumped = stored(jumped, f"{folder}/labels-{k}")
        labels = jumped.select("node", "root")
        if jumped.where("root <> old").isEmpty():
            return labels
