"""Which sources know a key, and how often."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Source:
    """Keys of one source. ``keys`` has the key as its only column; ``count`` names
    the output column with the number of rows, None when it is not published."""

    name: str
    keys: DataFrame
    count: str | None = None


def presence_matrix(sources: Sequence[Source], key: str) -> DataFrame:
    """One row per key found anywhere, ``has_<source>`` flags and row counts.

    The sources are stacked and aggregated once: one shuffle with map-side partial
    sums, where a join per source would take one shuffle each. A NULL key keeps its row
    but belongs to no source, as it would with equality joins.
    """
    stacked = reduce(
        DataFrame.unionByName,
        [s.keys.select(F.col(key), F.lit(s.name).alias("__source")) for s in sources],
    )
    known = F.col(key).isNotNull()

    def of(source: Source) -> Column:
        return known & (F.col("__source") == source.name)

    flags = [
        F.coalesce(F.max(of(s)), F.lit(False)).alias(f"has_{s.name}") for s in sources
    ]
    counts = [F.count(F.when(of(s), 1)).alias(s.count) for s in sources if s.count]
    return stacked.groupBy(key).agg(*flags, *counts)


def key_union(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Distinct keys of several tables."""
    return reduce(DataFrame.unionByName, [f.select(key) for f in frames]).distinct()
