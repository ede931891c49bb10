"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); a component is its smallest node.

    Each round takes the smallest label among a node's neighbours and then the label of its
    label (pointer jumping), until nothing changes.  Every round is written to shared storage;
    nothing is collected but the number of changes.  Empty edges: no rows.
    """
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .where(F.col("a") != F.col("b")).distinct())
    labels = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
                    .select(F.col("a").alias("node"), "label"))
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy("a").agg(F.min("label").alias("near")))
        lower = (labels.join(near, F.col("node") == F.col("a"), "left")
                 .select("node", "label", F.least("label", F.coalesce("near", "label")).alias("low")))
        lower = staged(lower)
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        new = staged(lower.join(jump, "low", "left").select(
            "node", F.least("low", F.coalesce("lower", "low")).alias("new"), "label"))
        if not new.where(F.col("new") != F.col("label")).limit(1).count():
            return new.select("node", F.col("new").alias("component"))
        labels = new.select("node", F.col("new").alias("label"))
