"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import drop_staged, stage


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): (node, component), component being the smallest node reachable.

    Labels start at the smallest neighbour. Each round takes the smallest label among a node's neighbours and then that
    label's own label (pointer jumping), until a round changes nothing. All tables are staged; the joins read scans on
    either side, so that adaptive execution can split a node with very many edges. Nothing but one row per round is
    collected. Nodes without an edge to another node are not listed.
    """
    pairs = edges.where(F.col("a") != F.col("b"))
    both = stage(pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    old = [labels]
    while True:
        near = both.join(labels.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(F.min("label").alias("near"))
        lower = stage(labels.join(near, "node").select("node", F.least("label", "near").alias("label"), (F.col("near") < F.col("label")).alias("changed")), "labels")
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("up"))
        after = stage(lower.join(up, "label").select("node", F.least("label", "up").alias("label"), (F.col("changed") | (F.col("up") < F.col("label"))).alias("changed")), "labels")
        drop_staged(lower)
        changed = after.where("changed").limit(1).count()
        if not changed:
            return after.select("node", F.col("label").alias("component"))
        for x in old:
            drop_staged(x)
        labels, old = after.select("node", "label"), [after]
