"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeep.llm.shared import stored

#: Files of a round for each core. Nodes and labels are narrow, and there are as many rounds as the paths are long.
_FILES = 2


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): the label is the smallest node of its component.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so the number of rounds grows with the logarithm of the
    longest path. Neighbours' labels are combined before they move, and every
    round is written to the shared folder, in a few files a core however many
    partitions shuffles have. No link table gives no rows.
    """
    few = lambda df: df.coalesce(_FILES * df.sparkSession.sparkContext.defaultParallelism)
    both = stored(few(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()))
    labels = stored(few(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label").hint("rebalance"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("_near"))
        )
        lower = labels.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("_low"))
        # follow the label once; hot labels are many rows of the left side
        jump = labels.select(F.col("node").alias("_low"), F.col("label").alias("_jump")).hint("rebalance")
        new = stored(few(lower.join(jump, "_low").select("node", "_old", F.least("_low", "_jump").alias("label"))))
        labels = new.select("node", "label")
        if new.filter("label <> _old").isEmpty():
            return labels
