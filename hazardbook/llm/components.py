"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardbook.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node it reaches) of every node in ``links``
    (columns ``a``, ``b``).

    Every round a node takes the smallest label among its neighbours and then its
    label's label, so paths shorten by doubling. Rounds end when no label changes; a
    round's labels are written before the next reads them. A hub's neighbours are
    reduced to their minimum before they are exchanged.
    """
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = stage(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select(
            "node", F.least("node", "near").alias("label")
        )
    )
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(
            F.col("a").alias("node")
        ).agg(F.min("label").alias("near"))
        taken = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("new")
        )
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("next"))
        moved = stage(
            taken.join(jump, "new").select("node", "old", F.least("new", "next").alias("label"))
        )
        labels = moved.select("node", "label")
        if moved.where("old != label").isEmpty():
            return labels
