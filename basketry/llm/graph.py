"""Connected components of a link table, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the least node of the component) for every node of ``links``.

    Every round a node takes the least label among its own and its neighbours', then the
    label of that label; rounds grow with the logarithm of a component's width.  A hot node costs
    one row a task (minimum with partial aggregation).  Each round is written to the shared folder;
    the driver sees one number a round."""
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).union(links.select(F.col(b), F.col(a)))
    both = materialize(both.where("node <> other").distinct(), "cc-links")
    labels = materialize(both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "cc-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "component"), "other").groupBy("node").agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        step = materialize(
            step.join(jump, "component", "left").select("node", "was", F.least("component", F.coalesce("far", "component")).alias("component")),
            "cc-labels",
        )
        if not step.where("component <> was").limit(1).count():
            return step.select("node", "component")
        labels = step.select("node", "component")
