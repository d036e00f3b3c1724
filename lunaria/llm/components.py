"""Connected components of an edge table: minimum labels with pointer jumping, all in shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for every end of edges(a, b): label is the smallest id reachable, itself included.

    Each round takes the smallest label among a node and its neighbours (summed up before the
    shuffle, so a hub costs one row a task) and then the label of that label; path lengths shrink
    by a constant factor a round. Every round is written to the shared folder. Edges with a null end
    are ignored; loops and repeated edges are harmless; no edges give no rows.
    """
    e = edges.where("a is not null and b is not null").select("a", "b")
    both = cut(e.union(e.select(F.col("b"), F.col("a"))).toDF("src", "dst").distinct(), "edges")
    labels = cut(both.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("id"), F.least("src", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.toDF("src", "l"), "src").groupBy("dst").agg(F.min("l").alias("m"))
        low = labels.join(near, labels.id == near.dst).select("id", "label", F.least("label", "m").alias("now"))
        jump = labels.toDF("at", "to")
        new = cut(low.join(jump, low.now == jump["at"]).select("id", "label", F.least("now", "to").alias("now")), "labels")
        labels = new.select("id", F.col("now").alias("label"))
        if new.where("now <> label").isEmpty():
            return labels
