"""Connected components of a link table, all in joins and reducing aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.shared import write_shared


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label`` for each node of a link; the label is the component's smallest node.

    Each round gives a node the smallest label around it, then the label's own
    label, so a path of n links takes about log n rounds.  Rounds are written
    to the shared folder: a lost executor costs a re-read.  A popular node is
    reduced inside each task, or split by the skew join.  Rows with a null end
    are ignored; an empty table has no components.
    """
    ends = links.select(F.col(a).alias("node"), F.col(b).alias("near")).dropna()
    both = ends.unionByName(ends.select(F.col("near").alias("node"), F.col("node").alias("near")))
    both = write_shared(both, "links")
    first = both.groupBy("node").agg(F.min("near").alias("label"))
    labels = write_shared(first.select("node", F.least("node", "label").alias("label")), "labels")
    last = None
    while True:
        near = both.join(labels.withColumnRenamed("node", "near"), "near").select("node", "label")
        least = write_shared(labels.unionByName(near).groupBy("node").agg(F.min("label").alias("label")), "labels")
        onward = least.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        jumped = least.join(onward, "label").select("node", F.least("label", "_next").alias("label"))
        jumped = write_shared(jumped, "labels")
        total = jumped.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        labels = jumped
        if total == last:  # labels only ever fall
            return labels
        last = total
