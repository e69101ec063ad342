"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): comp is the smallest node of the component.  Nodes are longs; `edges` has columns a and b.

    Each round takes the smallest label among a node and its neighbours (a
    partial aggregate, so a hub does not meet in one task), then follows the
    label's own label.  Rounds go on until no label changes; each is written
    to the shared folder, so a lost executor costs one round.  No edges: no rows.
    """
    both = stored(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")) \
        .select("node", F.least("node", "m").alias("comp"))
    while True:
        labels = stored(labels, "labels")
        near = (both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        step = labels.join(near, "node").select(
            "node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        up = step.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        jumped = stored(step.join(up, "comp").select("node", "was", F.col("up").alias("comp")), "labels")
        if jumped.filter("comp <> was").isEmpty():
            return jumped.select("node", "comp")
        labels = jumped.select("node", "comp")
