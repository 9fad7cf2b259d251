"""Connected components of an edge table by minimum labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (its component's smallest node) for every node of ``edges`` (columns ``a``, ``b``).

    Each round takes the smallest label among the neighbours (combined before
    the shuffle, so hubs are cheap) and then the label's own label, which halves long
    chains; every round is a written table. No links or labels reach the driver,
    only the number of nodes that still change.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("root")), "labels")
    while True:
        heard = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        nearer = labels.join(heard, "node").select("node", F.least("root", "near").alias("low"), F.col("root").alias("was"))
        target = labels.select(F.col("node").alias("t"), F.col("root").alias("beyond"))
        stepped = nearer.join(target, F.col("low") == F.col("t"), "left").select("node", F.least("low", F.coalesce("beyond", "low")).alias("root"), "was")
        stepped = written(stepped, "labels")
        moved = stepped.where("root != was").count()
        labels = stepped.select("node", "root")
        if not moved:
            return labels
