"""Connected components as labels that spread over links, in Spark joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.blocks import cut


def spread_labels(labels: DataFrame, links: DataFrame, node: str) -> DataFrame:
    """labels (node, label) after every node has got the smallest label of its component; links: (a, b), any direction.

    Each round every linked node takes the least label among its neighbours and its own; rounds end when none
    changes. Hubs are joins on checkpointed sides (adaptive execution splits them) and minima that combine before
    the shuffle. Nodes without links keep their labels.
    """
    both = cut(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    linked = both.select(F.col("a").alias(node)).distinct()
    now = cut(labels.join(linked, node, "left_semi").select(node, "label"))
    while True:
        heard = both.join(now.withColumnRenamed(node, "b"), "b").select(F.col("a").alias(node), "label", F.lit(None).cast(labels.schema["label"].dataType).alias("was"))
        own = now.select(node, "label", F.col("label").alias("was"))
        now = cut(heard.unionByName(own).groupBy(node).agg(F.min("label").alias("label"), F.min("was").alias("was")))
        if now.where("label < was").isEmpty():
            break
        now = now.select(node, "label")
    done = now.select(node, F.col("label").alias("least"))
    return cut(labels.join(done, node, "left").select(node, F.coalesce("least", "label").alias("label")))
