"""Connected components of a graph of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stored


#: A task takes about so many pairs.
PAIRS_PER_TASK = 50_000


def components(pairs: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``pairs`` (a, b) can reach.

    Labels fall to the smallest of the neighbours' in every round, and then to the label's own
    label, so that a chain of n nodes takes about log n rounds. The neighbours of a node with many
    are reduced in the map tasks first. Each round is a written table. As many tasks as the
    pairs need do the work, whatever the number of shuffle partitions.
    """
    both = stored(
        pairs.select("a", "b").where("a <> b")
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.a", "e.b").distinct(),
        "links",
    )
    tasks = 1 + both.count() // PAIRS_PER_TASK
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")).coalesce(tasks), "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"]).coalesce(tasks)
            .groupBy("a").agg(F.min("label").alias("near")).coalesce(tasks)
        )
        # a smaller label near a node is news for the node's label, too
        hooks = (
            near.join(labels, near["a"] == labels["node"])
            .select("node", "label", F.least("label", "near").alias("low")).coalesce(tasks)
        )
        roots = hooks.groupBy(F.col("label").alias("root")).agg(F.min("low").alias("root_low")).coalesce(tasks)
        hooked = (
            hooks.join(roots, hooks["label"] == roots["root"])
            .select("node", "label", F.least("low", "root_low").alias("low")).coalesce(tasks)
        )
        jump = hooked.select(F.col("node").alias("to"), F.col("low").alias("to_low"))
        moved = stored(
            hooked.join(jump, hooked["low"] == jump["to"])
            .select("node", F.col("label").alias("was"), F.least("low", "to_low").alias("label"))
            .coalesce(tasks),
            "labels",
        )
        labels = moved.select("node", "label")
        if moved.where("was <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
