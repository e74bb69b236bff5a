"""Connected components of an edge table by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch


def components(scratch: Scratch, edges: DataFrame, name: str = "labels") -> DataFrame:
    """(id, label) for every end of ``edges (a, b)``; the label is the smallest id of the component.

    Every round each node takes the smallest label around it and then the label of that label, so
    paths shrink by half; minima combine before each shuffle, so a node with very many edges is
    one key of small rows, which adaptive execution may split in the join.
    """
    both = scratch.keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where(
        "a <> b").distinct(), f"{name}-edges")
    labels = scratch.keep(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "id"), f"{name}-0")
    number = 0
    while True:
        number += 1
        around = both.join(labels, F.col("b") == F.col("id")).select(F.col("a").alias("id"), "label")
        least = around.unionByName(labels).groupBy("id").agg(F.min("label").alias("near"))
        further = labels.select(F.col("id").alias("_id"), F.col("label").alias("_label"))
        new = least.join(further, F.col("near") == F.col("_id"), "left").select("id", F.least("near", "_label").alias("label"))
        new = scratch.keep(new, f"{name}-{number}")
        changed = new.join(labels.withColumnRenamed("label", "old"), "id").where("label <> old").limit(1).count()
        scratch.drop(labels)
        labels = new
        if not changed:
            scratch.drop(both)
            return labels
