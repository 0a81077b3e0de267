"""Connected components over links in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node reachable.

    Each round every node takes the smallest label among its own and its
    neighbours', then follows that label one step (pointer jumping), so the
    rounds grow with the logarithm of a component's width.  Labels of a hub are
    combined on the map side; the joins are plain, so adaptive execution splits
    a hub's rows.  Every round is written to the shared folder, only a count
    comes to the driver.  Null nodes are ignored; an empty input gives no rows.
    """
    clean = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = stored(clean.select(F.col(a).alias("x"), F.col(b).alias("y"))
                   .unionByName(clean.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct(), "links")
    labels = stored(edges.groupBy(F.col("x").alias("node"))
                    .agg(F.least(F.col("node"), F.min("y")).alias("root")), "labels")
    while True:
        seen = (edges.join(labels.withColumnRenamed("node", "y"), "y")
                .groupBy(F.col("x").alias("node")).agg(F.min("root").alias("near")))
        step = (labels.join(seen, "node", "left")
                .select("node", F.col("root").alias("old"),
                        F.least(F.col("root"), F.col("near")).alias("mid")))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        new = stored(step.join(jump, "mid", "left")
                     .select("node", F.least(F.col("mid"), F.coalesce("far", "mid")).alias("root"), "old"), "labels")
        labels = new.select("node", "root")
        if not new.where(F.col("root") != F.col("old")).limit(1).count():
            return labels
