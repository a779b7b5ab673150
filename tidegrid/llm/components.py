"""Connected components of a table of links, by least labels and pointer jumping.

Each round takes the least label among a vertex and its neighbours, then the label's own label, so the
distance covered doubles. Every round is written to the shared folder: lineage stays short and survives a
lost executor. Only a count of changes comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm._frames import discard, saved


def components(links: DataFrame) -> DataFrame:
    """(v, label) for links (a, b): label is the smallest vertex that v reaches."""
    both = saved(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = saved(both.groupBy(F.col("a").alias("v")).agg(F.least("v", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.v).groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        better = labels.join(near, "v", "left").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        target = better.select(F.col("v").alias("label"), F.col("label").alias("next"))
        jumped = better.join(target, "label", "left").select("v", "old", F.least("label", "next").alias("label"))
        done = saved(jumped, "labels")
        discard(labels)
        labels = done.select("v", "label")
        if done.where("label < old").isEmpty():
            discard(both)
            return labels
