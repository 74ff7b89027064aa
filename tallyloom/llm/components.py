"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b); label is the smallest node reachable. Rows with a null end are no links; without links there are no nodes.

    Each round takes the smallest label among a node and its neighbours, then that label's own label, and is written
    to the shared folder. Labels reach over twice the distance in each round, so rounds grow with the logarithm of the
    longest path. Nodes and links never reach the driver, only the number of labels that changed.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL")
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        least = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        new = labels.join(least, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = written(new.join(up, "label").select("node", "old", F.least("label", "further").alias("label")))
        changed = new.where("label != old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
