"""Connected components of many small or few large graphs at once, by label propagation in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.sources.scratch import Scratch, counting


def component_labels(nodes: DataFrame, links: DataFrame, key: list[str]) -> DataFrame:
    """(key, node, label): label is the smallest node that a node's links reach; graphs are told apart by key.

    nodes (key, node), each once; links (key, a, b) between nodes of one graph, in either direction, repeated or to
    themselves. Each round a node takes the smallest label next to it and then its label's own label, so distances
    double. A round is written to shared storage, and how many labels changed is observed in that same pass. Only nodes
    with links take part; keys are joined together with nodes, so a large graph is spread over tasks.
    """
    ends = lambda a, b: links.select(*key, F.col(a).alias("u"), F.col(b).alias("v"))
    both = Scratch(ends("a", "b").union(ends("b", "a")).where("u <> v").distinct(), "links")
    now = Scratch(both.df.select(*key, F.col("u").alias("node"), F.col("u").alias("label")).distinct(), "labels", left=counting(F.lit(True)))
    while now.counts["left"]:
        old = now.df
        near = both.df.join(old.withColumnsRenamed({"node": "v", "label": "m"}), [*key, "v"]).groupBy(*key, "u").agg(F.min("m").alias("m"))
        met = old.join(near.withColumnRenamed("u", "node"), [*key, "node"]).select(*key, "node", F.col("label").alias("before"), F.least("label", "m").alias("via"))
        further = met.join(old.withColumnsRenamed({"node": "via", "label": "next"}), [*key, "via"]).select(*key, "node", "before", F.least("via", "next").alias("label"))
        new = Scratch(further, "labels", left=counting(F.col("label") != F.col("before")))
        now.drop()
        now = new
        now.df = now.df.select(*key, "node", "label")
    both.drop()
    return nodes.join(now.df, [*key, "node"], "left").select(*key, "node", F.coalesce("label", "node").alias("label"))
