"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a narrow table one task may well hold.
ROWS_A_TASK = 200_000


def settled(df: DataFrame, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """The table written to the checkpoint folder, in as few partitions as its rows call for.

    Steps on what is left of a large table would else run, and write, as many tiny tasks as the large one had.
    """
    df = df.checkpoint()
    return df.coalesce(max(1, -(-df.count() // rows_a_task)))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp): comp is the smallest node reachable over the edges (a, b). Nodes without edges are not listed.

    Each turn a node takes the smallest label among its own, its neighbours' and that of the node its label names, so chains
    shorten by half; labels are written to the checkpoint folder every turn. Only a count of changes comes to the driver.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    both = settled(both.distinct())
    tasks = both.rdd.getNumPartitions()
    labels = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("comp")).coalesce(tasks).checkpoint()
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), F.col("comp").alias("c")), "other").coalesce(tasks).groupBy("node").agg(F.min("c").alias("near"))
        step = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp")).coalesce(tasks)
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        step = step.join(jump, "comp", "left").select("node", F.least("comp", F.coalesce("up", "comp")).alias("comp"), "old").coalesce(tasks).checkpoint()
        changed = step.filter(F.col("comp") != F.col("old")).limit(1).count()
        labels = step.select("node", "comp")
        if not changed:
            return labels
