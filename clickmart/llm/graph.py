"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.operators.materialize import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its smallest node.

    Every round takes the smallest label among the neighbours and then the label of that label, so labels
    travel twice as far each time. Rounds are written, which keeps the plan short and outlives executors.
    Repeated edges and loops are allowed; a null end is ignored.
    """
    one_way = edges.select("a", "b").where("a is not null and b is not null").distinct()
    edges = materialize(one_way.union(one_way.select("b", "a")).distinct())
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    while True:
        labels = materialize(labels)
        beside = (
            edges.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("label").alias("least"))
        )
        near = labels.join(beside, F.col("node") == F.col("a")).select(
            "node", F.least("label", "least").alias("near"), F.col("label").alias("old")
        )
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        step = materialize(
            near.join(jump, "near", "left").select(
                "node", F.least("near", F.coalesce("far", "near")).alias("label"), "old"
            )
        )
        if step.where("label <> old").isEmpty():
            return step.select("node", F.col("label").alias("component"))
        labels = step.select("node", "label")
