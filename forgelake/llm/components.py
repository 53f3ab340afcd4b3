"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.tables import stored

_STEPS = 100


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links(a, b)``; the label is the smallest node of
    its component.

    Each step takes the smallest label among a node's own and its neighbours', then the
    label of that label, so that labels travel twice as far each time; every step is a table
    of its own. A node with very many links is one hot join key, which adaptive execution
    splits, and its labels are reduced before the shuffle. Null nodes are left out; repeated
    links and loops are harmless; no links give no rows.
    """
    links = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label"))
    labels = stored(labels, "labels")
    for _ in range(_STEPS):
        own = labels.select("node", "label", F.col("label").alias("old"))
        near = both.join(labels.withColumnRenamed("node", "b"), "b")
        near = near.select(F.col("a").alias("node"), "label", F.lit(None).cast(labels.schema["label"].dataType).alias("old"))
        least = own.union(near).groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = least.join(jump, "label", "left").select("node", F.least("label", "next").alias("label"), "old")
        new = stored(new, "labels")
        labels = new.select("node", "label")
        if new.where("label <> old").isEmpty():
            return labels
    raise RuntimeError("labels did not settle")
