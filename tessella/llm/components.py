"""Connected components of a link table, without gathering links anywhere.

Labels start at the smallest neighbour. Each round takes the smallest label among a node's neighbours and then the label
of that label, so the distance a label travels doubles; each round is written to the shared folder, which cuts lineage.
More than SENT links are joined by sort and merge alone, whatever Spark takes their files to weigh: no broadcast through the
driver grows with them.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm import storage

SENT = 10_000


def components(pairs: DataFrame, passes: int | None = None) -> DataFrame:
    """(node, label) for every node that a pair (a, b) names; label is the smallest node of its component. A written table.
    After so many passes, if given, labels may be larger: nodes of one label are linked, but not the other way round."""
    both = pairs.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("to"))).where("node <> to")
    links = storage.written(both.distinct(), "links")
    many = links.count() > SENT
    part = lambda df: df.hint("merge") if many else df
    labels = storage.written(links.groupBy("node").agg(F.min("to").alias("label")).select("node", F.least("node", "label").alias("label")), "labels")
    for done in count(1):
        seen = links.join(part(labels.select(F.col("node").alias("to"), "label")), "to").groupBy("node").agg(F.min("label").alias("near"))
        lower = labels.select("node", "label").join(part(seen), "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        roots = lower.select(F.col("node").alias("root"), F.col("label").alias("above"))
        jumped = lower.join(part(roots), lower.label == roots.root).select("node", "was", F.least("label", "above").alias("label"))
        moved = storage.written(jumped, "labels")
        storage.drop(labels)
        labels = moved
        if done == passes or moved.where("label <> was").isEmpty():
            storage.drop(links)
            return labels
