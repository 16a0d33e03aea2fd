"""Connected components of a table of links, by repeated exchange of smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b): the smallest node it can reach.

    Each round a node takes the smallest label among its neighbours, then the label of its
    label, so chains shorten by half. Rounds are written tables; only a count of changes
    reaches the driver. A node with very many links is combined before the shuffle.
    """
    both = staged(
        links.select("a", "b")
        .union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b")
        .distinct(),
        "links",
    )
    labels = staged(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        .select("node", F.least("node", "low").alias("component")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("low"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "low").alias("low")
        )
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("jumped"))
        # What links two labels also pulls the larger label itself down.
        pulled = (
            lower.groupBy(F.col("before").alias("low")).agg(F.min("low").alias("pulled"))
        )
        following = staged(
            lower.join(jump, "low", "left")
            .withColumn("component", F.least("low", F.coalesce("jumped", "low")))
            .select("node", "before", "component")
            .join(pulled.withColumnRenamed("low", "node"), "node", "left")
            .select("node", "before", F.least("component", F.coalesce("pulled", "component")).alias("component")),
            "labels",
        )
        labels = following.select("node", "component")
        if following.where("before <> component").isEmpty():
            return labels
