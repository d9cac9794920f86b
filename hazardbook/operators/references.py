"""Resolving both ends of an edge against the objects it names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardbook.operators.latest import latest_per_key
from hazardbook.operators.skew import own_shuffle


def resolve_ends(
    edges: DataFrame,
    objects: DataFrame,
    scope: Sequence[str],
    object_key: str,
    attributes: Sequence[str],
    ends: Sequence[tuple[str, str]],
    position: str,
) -> DataFrame:
    """Add ``<prefix>_<attribute>`` for every end ``(reference column, prefix)``.

    Unresolved references keep their row with NULL attributes. Objects are made unique
    per (scope, key), the last one by ``position`` wins. Popular targets are the left
    side of a left join, which AQE splits when they pile up in one partition.
    """
    unique = latest_per_key(objects, [*scope, object_key], position)
    result = edges
    for reference, prefix in ends:
        side = unique.select(
            *[
                own_shuffle(F.col(c)).alias(f"__{prefix}_{c}")
                for c in (*scope, object_key)
            ],
            *[F.col(a).alias(f"{prefix}_{a}") for a in attributes],
        )
        on = [F.col(c) == F.col(f"__{prefix}_{c}") for c in scope]
        on.append(F.col(reference) == F.col(f"__{prefix}_{object_key}"))
        result = result.join(side, on, "left").drop(
            *[f"__{prefix}_{c}" for c in (*scope, object_key)]
        )
    return result
