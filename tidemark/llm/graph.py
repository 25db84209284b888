"""Connected components of a table of links, by falling labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import removed, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node that has a link; no table is collected."""
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = written(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        around = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near")).withColumnRenamed("a", "node")
        low = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = low.join(labels.select(F.col("node").alias("label"), F.col("label").alias("further")), "label", "left")
        new = written(jump.select("node", "old", F.coalesce("further", "label").alias("label")), "labels")
        removed(labels)
        labels = new
        if not new.where("label <> old").limit(1).count():
            removed(edges)
            return new.select("node", F.col("label").alias("component"))
