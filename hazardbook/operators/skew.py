"""Keeping joins open to AQE's splitting of skewed partitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def own_shuffle(key: Column) -> Column:
    """The same value as an expression of its own, for the small side of a join.

    A side that was made unique by a window is already partitioned by its key, so Spark
    would join it in place and could then not split the other side's hot partitions:
    AQE splits a join only where both inputs come straight out of a shuffle. Joining on
    this expression makes Spark shuffle the unique side once more, which is cheap next
    to a third of all rows in one task.
    """
    return F.greatest(key, key)
