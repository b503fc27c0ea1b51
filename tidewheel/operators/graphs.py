"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.sources.sinks import materialised

MOST_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component``: the smallest node that each node of the edges is connected to.

    Every round, a node takes the smallest label among its own and its neighbours', and then the
    label of the node that this label names. Labels so travel twice as far each round: the number of
    rounds is near the logarithm of the longest path. Nodes with very many edges are combined before
    the shuffle, and the joins are equi-joins that adaptive execution splits. Each round is written,
    so a lost executor repeats one round at most.
    """
    ways = edges.select(F.col(a).alias("_from"), F.col(b).alias("_to"))
    ways = ways.unionByName(ways.select(F.col("_to").alias("_from"), F.col("_from").alias("_to")))
    ways = materialised(ways.where("_from <> _to").distinct(), "edges")
    labels = materialised(ways.groupBy(F.col("_from").alias("_node")).agg(F.least("_node", F.min("_to")).alias("_label")), "labels")
    for _ in range(MOST_ROUNDS):
        heard = ways.join(labels.withColumnRenamed("_node", "_from"), "_from").select(F.col("_to").alias("_node"), "_label")
        least = heard.unionByName(labels).groupBy("_node").agg(F.min("_label").alias("_label"))
        least = materialised(least, "heard-labels")
        named = least.select(F.col("_node").alias("_label"), F.col("_label").alias("_next"))
        jumped = least.join(named, "_label").select("_node", F.col("_next").alias("_label"))
        before = labels.select("_node", F.col("_label").alias("_old"))
        new = materialised(jumped.join(before, "_node"), "labels")
        labels = new.select("_node", "_label")
        if new.where("_label <> _old").isEmpty():
            return labels.select(F.col("_node").alias("node"), F.col("_label").alias("component"))
    raise RuntimeError(f"labels did not settle in {MOST_ROUNDS} rounds")
